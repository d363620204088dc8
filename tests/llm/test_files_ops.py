"""Token files (exact round trip), the id coder, HTML extraction and the WARC
audit against plain versions."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_small_ops import docs_of, sample_texts
from tokenizers import Tokenizer

from loomis.llm import fixity
from loomis.llm.htmltext import extract_text, main_text
from loomis.llm.idcoder import decode_block, encode_block
from loomis.llm.tokenfile import read_token_files, write_token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 511, 513, 4097, 60001])
def test_coder_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (np.minimum(rng.zipf(1.3, n), 50257) - 1, rng.integers(0, 50257, n), np.full(n, 7)):
        block = encode_block(ids, 50257)
        assert (decode_block(block) == ids).all()
    assert len(encode_block(np.full(n, 7), 50257)) < 200 + n


def test_coder_learns_and_detects_damage():
    rng = np.random.default_rng(0)
    ids = np.tile(rng.integers(0, 50257, 200), 400)
    block = bytearray(encode_block(ids, 50257))
    assert len(block) * 8 / len(ids) < 8
    block[len(block) // 2] ^= 1
    with pytest.raises(ValueError):
        decode_block(bytes(block))


@pytest.mark.parametrize("block_ids", [64, 1 << 20])
def test_token_files(spark, tmp_path, block_ids):
    lib = Tokenizer.from_file(PATH)
    texts = sample_texts(21, 80) + ["a  b", "a \n b", " lead", "trail ", "x\n y", "<|endoftext|> z", "a  b", "日本 語"]
    docs = docs_of(spark, texts)
    out = str(tmp_path / f"t{block_ids}")
    write_token_files(docs, PATH, out, block_ids=block_ids)
    got = sorted(read_token_files(spark, out).collect(), key=lambda r: r.doc_id)
    start = 0
    for r, t in zip(got, texts, strict=True):
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        assert bytes(r.ids) == ids.tobytes()
        start += len(ids)


def test_token_files_in_parts_with_nulls_and_repeats(spark, tmp_path, monkeypatch):
    from loomis.llm import tokenfile
    monkeypatch.setattr(tokenfile, "PART_BYTES", 500)
    monkeypatch.setattr(tokenfile.id_parts, "__defaults__", (500,))
    rows = [(i // 2, f"text {i} " * (i % 9)) for i in range(200)] + [(None, "no id"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    out = str(tmp_path / "parts")
    write_token_files(docs, PATH, out, block_ids=50)
    got = sorted(read_token_files(spark, out, with_ids=False).collect(), key=lambda r: r.start)
    assert len(got) == len(rows) and spark.read.parquet(out).select("part").distinct().count() > 4
    ids = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(ids)
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))]


def test_empty_token_files(spark, tmp_path):
    docs = docs_of(spark, ["x"]).where("false")
    write_token_files(docs, PATH, str(tmp_path / "e"))
    assert read_token_files(spark, str(tmp_path / "e")).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style><script>var t="</p>";</script></head>
<body><nav><ul><li><a href="/a">Menu, one.</a></li></ul></nav><div class="ad">Buy, now. Really.</div>
%s<footer>&copy; me</footer></body></html>"""


def test_html_marked_article():
    art = "<article><h1>Head &amp; line</h1><p><b>One, two.<br><p>Three   <i>four</i>,\n five.</p><p>Six.</p>" \
          "<div class='comments'><p>First, lol.</p></div><form><p>Name, please.</p></form></article>"
    assert main_text(PAGE % art) == "Head & line\n\nOne, two.\n\nThree four, five.\n\nSix."


def test_html_unmarked_page():
    body = "".join(f"<p>Sentence number {i}, with some words, and more of them.</p>" for i in range(6))
    page = PAGE % ("<div id='content'>" + body + "</div><div class='links'><ul>" + "<li><a href='#'>link</a></li>" * 9
                   + "</ul></div>")
    assert main_text(page) == "\n\n".join(f"Sentence number {i}, with some words, and more of them." for i in range(6))


def test_html_odd_input(spark):
    long = "<article><p>" + "word, " * 60000 + "</p></article>"
    rows = [(1, "u", None, 0), (2, None, "", 0), (3, "u", "just text, no tags.", 0), (4, "u", "<p>cut <b", 0),
            (5, "u", "<article><p>a</p><!-- open <p>b</p>", 0), (6, "u", long, 0), (6, "u", long, 0), (None, "u", "<br>", 0)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    got = extract_text(d).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == 8 and extract_text(d.where("false")).collect() == []
    assert [by[i].text for i in (1, 2, 3, 4, 5, None)] == ["", "", "just text, no tags.", "cut", "a", ""]
    assert by[6].n_chars == len(("word, " * 60000).strip()) == len(by[6].text)


def _hashes(spark, rows):
    return spark.createDataFrame([(w, o, 10, h) for w, o, h in rows], "warc long, offset long, n_bytes long, hash string")


def test_audit_finds_exactly_the_differences(spark):
    rng = random.Random(3)
    a = {(w, o): f"h{rng.random()}" for w in range(70) for o in range(0, 2000, 50)}
    b = dict(a)
    want = set()
    for k in rng.sample(sorted(a), 12):
        what = rng.choice(["changed", "missing"])
        want.add((*k, what))
        if what == "changed":
            b[k] = "other"
        else:
            del b[k]
    b[(3, 1)], b[(99, 0)] = "x", "y"
    want |= {(3, 1, "extra"), (99, 0, "extra")}
    da, db = (_hashes(spark, [(w, o, h) for (w, o), h in x.items()]) for x in (a, b))
    found, roots = fixity.audit(da, db, range_bytes=100)
    assert {tuple(r) for r in found.collect()} == want
    same = {r.warc for r in roots.collect() if r.root_primary == r.root_replica}
    assert same == set(range(70)) - {w for w, _, _ in want}
    none, _ = fixity.audit(da, da, range_bytes=100)
    assert none.count() == 0
    lost, _ = fixity.audit(da, db.where("false"), range_bytes=100)
    assert lost.where("status = 'missing'").count() == len(a)


def test_warc_records(spark):
    d = spark.createDataFrame([(0, "u", "äh"), (1, None, None), (300, "v", "x"), (None, "w", "y"), (1, None, None)],
                              "page_id long, url string, html string")
    r = fixity.warc_records(d).orderBy("warc", "offset").collect()
    assert [x.warc for x in r] == [-1, 0, 0, 0, 1]
    assert r[2].offset == len(r[1].record.encode()) and "Content-Length: 3\r\n" in r[1].record
    assert fixity.audit_files(d).agg(F.sum("n_records")).first()[0] == 5
    assert fixity.audit_files(d.where("false")).count() == 0
