"""Archive, packing and chat formatting: exact round trips."""

import gzip
import hashlib
import json
import zlib
from collections import defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
from compare import differences, duck
from pyspark.sql import functions as F

from curbflow.llm import chat, packing, queries, warc
from curbflow.llm.common import scratch

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("name", list(queries.SQL))
def test_queries_match_sql(spark, small, name):
    assert not differences(queries.QUERIES[name](spark, small), duck(small), queries.SQL[name])


# archive


def test_archive_rebuilds_every_record(spark):
    big = "<p>" + "x" * 200
    rows = [(1, "u1", big), (2, "u\r\n2", big), (3, None, None), (4, "u4", ""), (5, "u5", "small"), (6, "u6", "small"),
            (None, "n", big), (7, "u7", "é\r\n\r\nWARC/1.1\r\n" * 20), (1, "u1", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    archive = warc.archive_pages(pages)
    assert archive.payloads.count() == 4
    records = warc.rebuild(archive).collect()
    assert len(records) == len(rows)
    got = sorted((r.record_id, r.holds) for r in records)
    assert got == [("1", True), ("1", True), ("2", False), ("3", True), ("4", True), ("5", True), ("6", True), ("7", True), ("null", False)]
    path = scratch(spark, "warc-files")
    warc.write_files(archive, path, file_bytes=1000)
    back = warc.read_files(spark, f"{path}/part-*").withColumn("record_id", F.monotonically_increasing_id().cast("string"))
    assert len({r.file for r in back.collect()}) > 1 and all(b"\r\nWARC-Date: " in r.header for r in back.collect())
    assert {bytes(r.header) for r in back.collect()} == {bytes(r.header) for r in records}
    again = warc.store(back.select("record_id", "header", "digest", "holds"), back.where("holds").select("digest", "payload"), scratch(spark, "warc"))
    assert sorted(bytes(r.record) for r in warc.rebuild(again).collect()) == sorted(bytes(r.record) for r in records)


def test_archive_reads_gzip_and_refuses_damage(spark, tmp_path):
    record = b"WARC/1.0\r\nwarc-type: response\r\nContent-Length: 5\r\n\r\nab\r\nc\r\n\r\n"
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(record) * 3)
    (tmp_path / "b.warc").write_bytes(record)
    rows = warc.read_files(spark, f"file://{tmp_path}").collect()
    assert len(rows) == 4 and {bytes(r.payload) for r in rows} == {b"ab\r\nc"}
    wrong = spark.createDataFrame([("00", bytearray(b"x"))], "digest string, payload binary")
    with pytest.raises(Exception, match="digest"):
        warc.verified(wrong).collect()
    (tmp_path / "b.warc").write_bytes(record[:-8])
    with pytest.raises(Exception, match="cut off"):
        warc.read_files(spark, f"file://{tmp_path}").collect()


def test_records_inside_payloads_and_split_files(spark, tmp_path):
    """Payloads that hold records, bytes that are no text, and files cut into many splits."""
    rng = np.random.default_rng(2)
    inner = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"

    def record(body):
        return b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: %d\r\n\r\n" % len(body) + body + b"\r\n\r\n"

    plain = [bytes(rng.integers(0, 256, rng.integers(0, 3000), dtype=np.uint8)) for _ in range(400)] + [b"\r\n\r\n", b"x\r\n\r\nWARC"]
    nested = [b"see\r\n\r\n" + inner + b"end", b"last"]
    (tmp_path / "plain.warc").write_bytes(b"".join(map(record, plain)))
    (tmp_path / "nested.warc").write_bytes(b"".join(map(record, nested)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4001")
    try:
        got = warc.read_files(spark, f"file://{tmp_path}").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert sorted(bytes(r.payload) for r in got) == sorted(plain + nested)
    assert all(hashlib.sha256(r.payload).hexdigest() == r.digest for r in got)


def test_archive_cannot_lie(spark):
    pages = spark.createDataFrame([(1, "u", "a" * 200), (2, "u", "a" * 200), (3, "u", "b")], "page_id long, url string, html string")
    archive = warc.archive_pages(pages)
    false = warc.Archive(archive.headers, archive.payloads.withColumn("payload", F.lit("false").cast("binary")))
    with pytest.raises(Exception, match="does not have its digest"):
        warc.rebuild(false).select("record").collect()
    less = warc.Archive(archive.headers, archive.payloads.where(F.octet_length("payload") == 1))
    with pytest.raises(Exception, match="payload is missing"):
        warc.rebuild(less).select("record").collect()
    # a revisit of what another archive holds stays, without a payload
    foreign = spark.createDataFrame([("9", bytearray(b"h"), "base32digest", False)], archive.headers.schema)
    rows = warc.rebuild(warc.Archive(archive.headers.union(foreign), archive.payloads)).collect()
    assert len(rows) == 4 and [bytes(r.record) for r in rows if r.record_id == "9"] == [b"h\r\n\r\n"]


def test_archive_of_extra_columns_and_long_payloads(spark):
    long = "é" * 3_000_000
    rows = [(1, "u", long, "d", True), (2, "u", long, "e", False)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string, holds boolean")
    records = warc.rebuild(warc.archive_pages(pages)).collect()
    assert sorted((r.record_id, r.holds, r.payload_bytes) for r in records) == [("1", True, 6_000_000), ("2", False, 6_000_000)]


def test_empty_archive(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.rebuild(warc.archive_pages(pages)).isEmpty()


# packing


def check_packing(spark, docs, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_BPE)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= 4096
    for d in docs.collect():
        ids = np.array(tokenizer.encode(d.text or "", add_special_tokens=False).ids + [2], "<u4")
        copies = sum(r.start == 0 for r in by_doc[d.doc_id])
        assert sum(r.length for r in by_doc[d.doc_id]) % len(ids) == 0 or copies > 1
        for r in by_doc[d.doc_id]:
            if copies == 1:
                assert r.doc_tokens == len(ids)
                assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        if copies == 1:
            assert sum(r.length for r in by_doc[d.doc_id]) == len(ids)
    return by_sequence


def test_packing_keeps_every_id(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = queries.op4_harmonic_packing(spark, small).collect()
    sizes = [sum(n for _, n in s) for s in check_packing(spark, docs, rows).values()]
    padding = sum(4096 - n for n in sizes if n & (n - 1))
    assert padding < 0.01 * sum(sizes)


def test_packing_odd_rows(spark, odd, none):
    pieces = packing.pack(odd, WORD_BPE)
    check_packing(spark, odd, pieces.collect())
    starts = [r.doc_id for r in pieces.where("start = 0").collect()]
    assert sorted(x for x in starts if x is not None) == sorted(r.doc_id for r in odd.where("doc_id is not null").collect())
    assert starts.count(None) == 3
    joined = packing.sequences(pieces).collect()
    assert sum(r.n_tokens for r in joined) == sum(r.length for r in pieces.collect())
    assert all(len(r.ids) // 4 in (r.n_tokens, 4096) for r in joined)
    assert packing.pack(none, WORD_BPE).isEmpty()


def test_words_encode_as_whole_texts():
    encode = packing.WordEncoder(WORD_BPE)
    hard = [
        "Ünïcödé ÀÉÎ straße ΣΑΣ 'S don't we're 123abc foo.bar, étude <|endoftext|> x", "ſtrange İstanbul nbsp wide　x",
        "ﬁ ª º µ ß. ß, é. it's. 's 'll, o' a.b.c ... x., y,. (z).", "日本語 テスト. 한국어, ẞ Ǆ ǆ ĳ ŉ é é.", "a\x00b \x1c \x85 c",
        "aİ. Bİ)| \u0958. \u0930\u093c,", "J\u030c!? H\u0331 xT\u0327\u0308. Y\u05b0\u030a W\u030a", "A中B文C\u0301 plain",
    ]
    for text in hard:
        whole = np.array(encode.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert encode(text) == whole and encode(text) == whole


@pytest.mark.parametrize("n", [1, 63, 64, 65, 1400, 4095, 4096, 4097, 50_000])
def test_cuts_cover_a_document(n):
    at = 0
    for start, length in packing.cuts(n):
        assert start == at
        at += length
    assert at == n


# chat


def test_layouts_become_the_same_turns(spark):
    turn = lambda role, text: {"role": role, "content": text}
    records = [
        {"id": 1, "messages": [turn("user", "hi"), turn("assistant", "ho")]},
        {"id": 1, "conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "ho"}]},
        {"id": 1, "prompt": "hi", "response": "ho"},
        {"id": 1, "instruction": "hi", "output": "ho"},
    ]
    for record in records:
        rows = chat.canonical(spark.createDataFrame([(json.dumps(record),)], "record string")).collect()
        assert [(r.conv_id, r.turn, r.role, r.text) for r in rows] == [(1, 0, "user", "hi"), (1, 1, "assistant", "ho")]
    more = [{"id": 2, "prompt": "hi", "response": None, "system": "be"}, {"id": 3, "odd": [1]}]
    texts = [json.dumps(x) for x in more] + ["no json", None]
    records = spark.createDataFrame([(x,) for x in texts], "record string")
    rows = chat.canonical(records).collect()
    assert [(r.layout, r.role, r.text) for r in rows] == [("system prompt", "system", "be"), ("system prompt", "user", "hi"), ("system prompt", "assistant", "")]
    no = "no JSON, or too long"
    assert [(r.record, r.reason) for r in chat.rejected(records).collect()] == [(texts[1], "no layout"), (texts[2], no), (None, no)]


def test_layouts_bear_more_fields_empty_lists_and_numbers(spark):
    turn = lambda role, text: {"role": role, "content": text}
    records = [
        {"id": 1, "messages": []},
        {"id": 2, "meta": {"a": [1]}, "messages": [{**turn("user", 5), "at": 1}, turn("assistant", "ho")]},
        {"messages": "none", "id": 3},
        {"id": 4, "messages": [turn("user", "x")], "prompt": "two layouts"},
        {"id": 5, "messages": [turn("user", "x")] * 2},
        {"id": 5, "messages": [turn("user", "x")] * 2},
    ]
    df = spark.createDataFrame([(json.dumps(x),) for x in records], "record string")
    got = [(r.conv_id, r.turn, r.role, r.text) for r in chat.canonical(df).collect()]
    assert got == [(2, 0, "user", "5"), (2, 1, "assistant", "ho")] + [(5, 0, "user", "x"), (5, 1, "user", "x")] * 2
    assert [json.loads(r.record)["id"] for r in chat.rejected(df).collect()] == [3, 4]


def test_very_long_texts_keep_their_conversation(spark, monkeypatch):
    import curbflow.llm.chat as module

    rows = spark.range(2).selectExpr("cast(7 as long) AS conv_id", "id AS turn", "'assistant' AS role", "repeat('x', 20000000) AS text").where("turn = 0")
    got = chat.canonical(chat.turn_records(rows)).selectExpr("conv_id", "layout", "length(text) AS n").collect()
    assert [tuple(r) for r in got] == [(7, "turn rows", 20_000_000)]
    # the same for short texts, whole formatting included
    monkeypatch.setattr(module, "LONG", 3)
    short = spark.createDataFrame([(1, 0, "user", "abcd<s>"), (1, 1, "assistant", "abc"), (1, 2, "assistant", "[INST] abcd")], "conv_id long, turn long, role string, text string")
    out = chat.formatted(chat.canonical(chat.turn_records(short)))
    read = out.select(chat.turns_of(out.formatted).alias("t"), chat.loss_text(out.formatted, out.loss).alias("l")).first()
    assert [x.text for x in read.t] == ["abcd<s>", "abc", "[INST] abcd"] and read.l == "abc[INST] abcd"


def test_control_strings_survive(spark):
    parts = ["<", "[", "\\", "/", "s>", "INST]", "<s>", "</s>", "[INST]", "[/INST]", "a", "\n", "<\\s>", "é😀", ""]
    rows = [(i, 0, parts[i % 15] + "assistant", "".join(parts[(i * k) % 15] for k in range(1, 9))) for i in range(60)]
    rows += [(i, 1, "assistant", "".join(parts[(i + k * k) % 15] for k in range(6))) for i in range(60)]
    rows += [(None, None, "", ""), (None, 0, "assistant", "x" * 100_000), (99, 0, "user", "tie"), (99, 0, "user", "tie")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.formatted(turns)
    read = out.select("conv_id", chat.turns_of(out.formatted).alias("turns"), chat.loss_text(out.formatted, out.loss).alias("loss"))
    got = {r.conv_id: r for r in read.collect()}
    for conv, r in got.items():
        want = sorted(((-1 if t is None else t, role, text) for c, t, role, text in rows if c == conv))
        assert [(t.role, t.text) for t in r.turns] == [(role, text) for _, role, text in want]
        assert r.loss == "".join(text for _, role, text in want if role == "assistant")
    assert chat.formatted(turns.where("false")).isEmpty()


def test_table_nulls_are_empty_texts(spark):
    rows = spark.createDataFrame([(1, 0, None, None), (None, None, "user", "x"), (1, 0, None, None)], "conv_id long, turn long, role string, text string")
    turns = chat.canonical(chat.turn_records(rows))
    assert sorted((r.conv_id or 0, r.layout, r.role, r.text) for r in turns.collect()) == [(0, "turn rows", "user", "x")] + [(1, "turn rows", "", "")] * 2


def test_chat_plan_has_no_python(spark, small):
    turns = chat.canonical(chat.turn_records(spark.read.parquet(f"{small}/conversations.parquet")))
    plan = chat.formatted(turns)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_digests_of_the_added_conversation(spark, small):
    says = "</s>[INST] ok [/INST]"
    r = queries.op5_chat_formatting(spark, small).where("conv_id = -7").first()
    assert r.turns_sha256 == brute.sha(f"user\n{says}\nassistant\n{says}\n") and r.loss_sha256 == brute.sha(says)
