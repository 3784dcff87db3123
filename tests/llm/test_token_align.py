import hashlib
import random
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quayside.llm import token_align
from quayside.llm.queries import TOKENIZERS, op12_token_align
from quayside.llm.tables import BATCH_SETTING, table

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def models():
    a = Tokenizer.from_file(TOKENIZERS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=TOKENIZERS[1])


def offsets(models, text):
    """Ids and byte ends by both tokenizers, from the libraries alone."""
    a, b = models
    whole = (" " + text).encode()
    letters = token_align.byte_letters()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    ids_b = b.encode(text)
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return None
    ends = []
    for pieces in (bytes_a, bytes_b):
        at, own = 0, []
        for piece in pieces:
            at += len(piece)
            own.append(at)
        ends.append(own)
    return ids_a, ends[0], ids_b, ends[1]


def brute(models, rows):
    cut = []
    for doc_id, text in rows:
        found = offsets(models, text) if text else None
        groups = []
        if found:
            ids_a, ends_a, ids_b, ends_b = found
            shared = sorted(set(ends_a) & set(ends_b))
            for start, end in zip([0, *shared], shared, strict=False):
                groups.append(([i for i, e in zip(ids_a, ends_a, strict=True) if start < e <= end], [i for i, e in zip(ids_b, ends_b, strict=True) if start < e <= end]))
        cut.append((doc_id, groups))
    held = Counter()
    for _, groups in cut:
        held.update({(x, y) for a, b in groups for x in a for y in b})
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for doc_id, groups in cut:
        links = [(x, y) for a, b in groups for x in a for y in b]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        sizes = [sum(len(g[k]) for g in groups) for k in (0, 1)]
        out.append((doc_id, *sizes, len(groups), len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links), digest))
    return sorted(out, key=str)


def rows_of(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=str)


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("block", F.lit("x")).withColumn("n_a", F.lit(-1))


PARTS = [
    " ", "  ", "\n", "\t", "\r\n", "a", "the ", "hello ", "Wörter ", "é", "<|endoftext|>", "<s>", "</s>", "<0x41>", " ", "日本", "😀", "\x00", "'s", "1", "2024",
    "!?", "‍", "﻿", "é", "\x85", "　", "\x1c", "can't ", "    ",
]


@pytest.mark.parametrize("block_bytes", [1, 200, 8 << 20])
def test_random_texts(spark, models, block_bytes):
    rng = random.Random(12)
    rows = [(i, "".join(rng.choice(PARTS) for _ in range(rng.randint(1, 40)))) for i in range(150)]
    rows += [(1000, None), (1001, ""), (1002, "a▁b"), (1003, " "), (None, "no id"), (5, rows[5][1]), (5, "other text"), (1004, "▁")]
    found = token_align.align(frame_of(spark, rows).repartition(3), *TOKENIZERS, block_bytes=block_bytes)
    assert rows_of(found) == brute(models, rows)


def test_forgetting_changes_nothing(spark, models, monkeypatch):
    monkeypatch.setattr(token_align, "MEMO_IDS", 10)
    rows = [(i, f"some words number {i} and some words again") for i in range(40)]
    assert rows_of(token_align.align(frame_of(spark, rows), *TOKENIZERS, block_bytes=100)) == brute(models, rows)


def test_whole_query_equals_brute_force(spark, models, sf_small):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf_small, "documents").collect()]
    short = [(i, t) for i, t in rows if len(t or "") < 3000]
    docs = table(spark, sf_small, "documents")
    small = docs.where(F.coalesce(F.length("text"), F.lit(0)) < 3000)
    assert rows_of(token_align.align(small, *TOKENIZERS)) == brute(models, short)
    assert op12_token_align(spark, sf_small).count() == len(rows)


@pytest.mark.parametrize("text", ["a" * 30_000, " " * 30_000 + "x", "word " * 30_000, "é€" * 5_000], ids=["run", "blanks", "words", "signs"])
def test_long_texts(spark, models, text):
    """One long run, blanks that both cut differently, and texts over the length that the fast library takes."""
    found = rows_of(token_align.align(frame_of(spark, [(1, text), (2, "a a")]), *TOKENIZERS))
    a, b = models
    one = next(r for r in found if r[0] == 1)
    assert one[1:3] == (len(a.encode(" " + text, add_special_tokens=False).ids), len(b.encode(text)))
    assert one[5] <= one[4] and one[3] <= one[4] <= one[6]


def test_a_million_blanks(spark):
    row = token_align.align(frame_of(spark, [(1, " " * 1_000_000)]), *TOKENIZERS).first()
    assert row["n_a"] > 0 and row["n_b"] > 0 and row["n_links"] >= row["n_groups"] >= 1


def test_both_libraries_agree(models):
    level = token_align.ByteLevel(TOKENIZERS[0])
    rng = random.Random(3)
    for _ in range(500):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(1, 30)))
        assert level.encode(text) == models[0].encode(text, add_special_tokens=False).ids


def test_empty_table(spark):
    assert rows_of(token_align.align(frame_of(spark, []), *TOKENIZERS)) == []


def test_memory_does_not_follow_links_or_rows_of_a_partition(spark, models):
    """Documents go to workers in bounded batches, a link of a block takes six bytes at most, and few blocks are buffered at once."""
    rows = [(i, f"{'some words and others ' * 20}{i}") for i in range(200)]
    docs = frame_of(spark, rows).coalesce(1)
    spark.conf.unset(BATCH_SETTING)
    try:
        assert rows_of(token_align.align(docs, *TOKENIZERS, block_bytes=2000)) == brute(models, rows)
        assert int(spark.conf.get(BATCH_SETTING)) <= 4 << 20
    finally:
        spark.conf.unset(BATCH_SETTING)
    blocks = token_align.aligned_blocks(docs, *TOKENIZERS, block_bytes=2000)
    found = blocks.select(F.expr("octet_length(pair) + octet_length(times)").alias("bytes"), F.expr("aggregate(n_pairs, 0L, (x, y) -> x + y)").alias("links")).collect()
    assert len(found) > token_align.GROUP_BLOCKS and all(0 < r["bytes"] <= 6 * r["links"] for r in found)
    groups = [m.row_group(i).num_rows for f in blocks.inputFiles() for m in [pq.ParquetFile(f.removeprefix("file://")).metadata] for i in range(m.num_row_groups)]
    assert sum(groups) == len(found) and max(groups) <= token_align.GROUP_BLOCKS
