"""loomis: Spark-native SFT-data and recommendation-evaluation operators."""

__version__ = "0.1.0"
