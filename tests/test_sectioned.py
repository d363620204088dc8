"""The sectioned data source, batch and stream, against the whole-file reader."""

import json
import os
import random
import tempfile
import time

from loomis.schemas import SECTION_HEADINGS
from loomis.sources import sectioned as sc
from loomis.sources import tasks

HEADS = [h for _, h in SECTION_HEADINGS]


def write_files(folder, n, seed=0):
    rng = random.Random(seed)
    for i in range(n):
        parts = ["前言 物料数据 示例\n"]
        for _ in range(rng.randrange(0, 6)):
            body = rng.choice(["", "{}", "{broken", json.dumps({f"t{rng.randrange(3)}": {"a": "值" * rng.randrange(50)},
                                                                 "k": "x"}, ensure_ascii=False), '{"d": 1, "d": 2}', '{"a": 1} tail'])
            parts.append(rng.choice(HEADS) + rng.choice("：:") + rng.choice(["", "\n", " "]) + body + "\n")
        sub = os.path.join(folder, f"d{i % 3}")
        os.makedirs(sub, exist_ok=True)
        with open(os.path.join(sub, f"f{seed}_{i}.txt"), "w") as f:
            f.write("".join(parts))
    with open(os.path.join(folder, "_hidden"), "w") as f:
        f.write(HEADS[0] + ":{}")


def rows(df):
    return sorted((os.path.basename(r.file), r.category, r.section_status, r.task or "", r.body_text or "")
                  for r in df.drop("body").collect())


def test_rows_equal_the_whole_file_reader(spark):
    with tempfile.TemporaryDirectory() as d:
        write_files(d, 40)
        want = rows(tasks.read_whole_files(spark, d))
        assert len(want) > 100
        assert rows(tasks.read_sectioned_tasks(spark, d)) == want
        assert rows(tasks.read_sectioned_tasks(spark, "file://" + d)) == want
        open(os.path.join(d, "empty.txt"), "w").close()     # Spark's text reader has no row for it
        few = sc.sections(spark, d, partitionBytes=3 << 16)
        assert few.rdd.getNumPartitions() == 14 and few.count() == 41 * len(HEADS)
        one = sc.sections(spark, os.path.join(d, "empty.txt")).collect()
        assert len(one) == 4 and all(r.section is None for r in one)


def test_cuts_do_not_depend_on_chunks():
    rng = random.Random(2)
    text = "".join(rng.choice([*HEADS, "：", ":", "物料", "x", "\n", "示例", "数据示例:"]) for _ in range(400)).encode()
    want = list(sc.cut_sections(iter([text])))
    assert 1 <= len(want) <= 4
    for size in (1, 2, 3, 7, 20, 64, 1000):
        assert list(sc.cut_sections(text[i:i + size] for i in range(0, len(text), size))) == want


def test_only_known_paths_are_opened():
    assert all(sc.readable(p) for p in ("/a/b", "a", "file:///a", "s3://b/k"))
    assert not any(sc.readable(p) for p in ("viewfs://store/a", "hdfs://n/a"))


def test_stream_takes_every_file_once(spark):
    with tempfile.TemporaryDirectory() as d:
        src, out, ckpt = (os.path.join(d, x) for x in ("in", "out", "ckpt"))
        os.makedirs(src)

        def run():
            q = sc.sections(spark, src, stream=True).writeStream.format("parquet").option("path", out) \
                .option("checkpointLocation", ckpt).trigger(availableNow=True).start()
            q.awaitTermination()
            return sorted((os.path.basename(r.file), r.category, r.section or "") for r in spark.read.parquet(out).collect())

        write_files(src, 7)
        first = run()
        assert len(first) == 28
        assert run() == first
        write_files(src, 5, seed=1)
        late = os.path.join(src, "d0", "late.txt")      # older than what was taken, but within the lateness
        with open(late, "w") as f:
            f.write(HEADS[1] + ":{}")
        os.utime(late, (time.time() - 600,) * 2)
        second = run()
        assert len(second) == 28 + 20 + 4
        want = sorted((os.path.basename(r.file), r.category, r.section or "") for r in sc.sections(spark, src).collect())
        assert second == want
