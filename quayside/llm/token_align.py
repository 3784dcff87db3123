"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, by whitespace-token anchors.

Each text is tokenised as a whole by both, a byte-level BPE (A) and a sentencepiece model (B). Both cover the bytes of the text after one space. Where tokens
of both end together before a token that starts with a space, the text is cut: a verified anchor. The windows between anchors are mostly
single words and recur, so the alignment of a window is kept by its two tuples of ids and worked out once for each of them in a task.

Texts are aligned in blocks of ``BLOCK_BYTES``. A block lists its distinct linked id pairs once, with the number of its documents that hold each; only these
lists are shuffled to count pairs over the corpus and to bring the counts back, a row for each pair and block instead of one for each link. Which of them each document
has is packed as bytes, and links are gathered for ``STEP_BYTES`` of text at a time, so that neither tasks nor the rows between them hold eight bytes for each link of a block.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quayside.llm.tables import bounded_batches, written
from quayside.llm.words import FACTOR, mixed, slices

#: Bytes of text in a block, and of text tokenised at once; a longer text is a block of its own.
BLOCK_BYTES, STEP_BYTES = 4 << 20, 1 << 20
#: Most ids in the windows that a task remembers from block to block.
MEMO_IDS = 2_000_000
#: Groups with more links than this are not paired one by one.
MANY_LINKS = 1024
#: Texts with more characters go through the slower library, which has no limit of white space in a row.
PLAIN_CHARS = 100_000
#: Fixed value: how the byte-level BPE cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = "▁"
SHIFT = 32
#: No id has these bytes.
BETWEEN = b"\xff\xff\xff\xff"
#: Most blocks in a row group of the written table, which is buffered as a whole where it is written and where it is read.
GROUP_BLOCKS = 16


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {**{chr(b): b for b in printable}, **{chr(0x100 + i): b for i, b in enumerate(others)}}


class ByteLevel:
    """A byte-level BPE from its ``tokenizers`` file; strings of special tokens are ordinary text."""

    def __init__(self, path: str):
        import tiktoken

        self.path, self.slow = path, None
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        special = {t["content"] for t in described["added_tokens"]}
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in described["model"]["vocab"].items() if token not in special}
        # Ids follow the order of merges, so they serve as ranks.
        self.fast = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = [b""] * (max(ranks.values()) + 1)
        for piece, i in ranks.items():
            self.pieces[i] = piece

    def encode(self, text: str) -> list[int]:
        if len(text) <= PLAIN_CHARS:
            return self.fast.encode_ordinary(text)
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.path)
            self.slow.encode_special_tokens = True
        return self.slow.encode(text, add_special_tokens=False).ids


class Pieces:
    """A sentencepiece model, which puts a space before each text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        named = [self.model.id_to_piece(i) for i in range(len(self.model))]
        self.pieces = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(named)
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1) if texts else []


class Groups:
    """Ids of two flat lists that cover the same bytes, cut wherever both have an end. ``at_a`` and ``at_b`` are the ends of the groups."""

    def __init__(self, a: np.ndarray, b: np.ndarray, a_lengths: np.ndarray, b_lengths: np.ndarray):
        self.a, self.b = a, b
        ends_a, ends_b = np.cumsum(a_lengths[a]), np.cumsum(b_lengths[b])
        at = np.searchsorted(ends_a, ends_b)
        both = np.flatnonzero(ends_a[at] == ends_b)
        self.at_a, self.at_b = at[both] + 1, both + 1

    def links(self, owners: np.ndarray, kinds_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Owner, pair of ids (that of A times ``kinds_b`` and that of B) and times for the links of groups with these owners, in the order of groups."""
        size_a, size_b = np.diff(self.at_a, prepend=0), np.diff(self.at_b, prepend=0)
        few = size_a * size_b <= MANY_LINKS
        sizes = np.where(few, size_a * size_b, 0)
        group = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        first, second = np.divmod(place, size_b[group]) if len(group) else (place, place)
        pairs = self.a[(self.at_a - size_a)[group] + first] * kinds_b + self.b[(self.at_b - size_b)[group] + second]
        parts = [(group, pairs, np.ones(len(group), np.int64))]
        for g in np.flatnonzero(~few):
            # Ids that stand many times in a group are counted, not paired one by one.
            one, n = np.unique(self.a[self.at_a[g] - size_a[g] : self.at_a[g]], return_counts=True)
            other, m = np.unique(self.b[self.at_b[g] - size_b[g] : self.at_b[g]], return_counts=True)
            pairs = (one[:, None] * kinds_b + other[None, :]).ravel()
            parts.append((np.full(len(pairs), g), pairs, (n[:, None] * m[None, :]).ravel()))
        group, pairs, times = (np.concatenate(p) for p in zip(*parts, strict=True))
        order = np.argsort(group, kind="stable")
        return owners[group[order]], pairs[order], times[order]

    def texts(self, names: list[str]) -> list[str]:
        """``a1,a2|b1`` for each group; ``names`` are the ids in decimals."""
        a, b = list(map(names.__getitem__, self.a.tolist())), list(map(names.__getitem__, self.b.tolist()))
        out, i, j = [], 0, 0
        for x, y in zip(self.at_a.tolist(), self.at_b.tolist(), strict=True):
            one, other = a[i] if x - i == 1 else ",".join(a[i:x]), b[j] if y - j == 1 else ",".join(b[j:y])
            out.append(f"{one}|{other}")
            i, j = x, y
        return out


def alike(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Runs with equal ids in all lists (flat ids, ends of runs) are one: the first of each, and for every run which of these it is.

    Runs are brought together by hashes and then compared, so a collision costs time only.
    """
    count = len(lists[0][1])
    runs, key = [], np.zeros(count, np.uint64)
    for ids, ends in lists:
        starts = np.concatenate([[0], ends[:-1]])
        place = np.arange(len(ids)) - np.repeat(starts, ends - starts)
        power = np.cumprod(np.full(place.max(initial=0) + 1, FACTOR))
        key = mixed(key + np.add.reduceat(mixed(ids.astype(np.uint64) + FACTOR) * power[place], starts))
        runs.append((ids, starts, ends - starts, place))
    _, first, same = np.unique(key, return_index=True, return_inverse=True)
    chosen = first[same]
    for ids, starts, sizes, place in runs:
        if (sizes != sizes[chosen]).any() or (ids != ids[np.repeat(starts[chosen], sizes) + place]).any():
            return np.arange(count), np.arange(count)
    return first, same


class Aligner:
    """Aligns blocks of texts and remembers the windows it has seen."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.a_lengths, self.b_lengths = (np.array([len(p) for p in pieces], np.int64) for pieces in (self.a.pieces, self.b.pieces))
        self.names = list(map(str, range(max(len(self.a.pieces), len(self.b.pieces)))))
        self.spaced = np.array([p.startswith(b" ") for p in self.a.pieces])
        self.kinds_b = len(self.b.pieces)
        self.pair_type = np.min_scalar_type(len(self.a.pieces) * self.kinds_b)
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = 0
        self.texts: list[str] = []
        nothing = np.zeros(0, np.int64)
        # For each window its groups and links; for all windows one after the other their distinct links' pairs and times.
        self.n_groups, self.n_links, self.n_pairs, self.pairs, self.times = nothing, nothing, nothing, nothing.astype(self.pair_type), nothing.astype(np.uint8)

    def _learn(self, fresh: list[tuple[bytes, bytes]]) -> None:
        """Align windows that were not known before, all at once; they cover the same bytes, so their groups don't run into each other."""
        a, b = (np.frombuffer(b"".join([w[k] for w in fresh]), np.int32).astype(np.int64) for k in (0, 1))
        until = np.cumsum([len(w[0]) // 4 for w in fresh])
        found = Groups(a, b, self.a_lengths, self.b_lengths)
        owners = np.searchsorted(until, found.at_a)
        counts = np.bincount(owners, minlength=len(fresh))
        texts, start = found.texts(self.names), 0
        for n in counts.tolist():
            self.texts.append(texts[start] if n == 1 else ";".join(texts[start : start + n]))
            start += n
        owner, pairs, times = found.links(owners, self.kinds_b)
        n_links = np.bincount(owner, weights=times, minlength=len(fresh)).astype(np.int64)
        # As few bytes as they take: nearly all links of a window stand there once.
        news = (counts, n_links, np.bincount(owner, minlength=len(fresh)), pairs.astype(self.pair_type), times.astype(np.min_scalar_type(times.max(initial=0))))
        self.n_groups, self.n_links, self.n_pairs, self.pairs, self.times = (
            np.concatenate([old, new]) for old, new in zip((self.n_groups, self.n_links, self.n_pairs, self.pairs, self.times), news, strict=True)
        )
        self.ids += len(a) + len(b)

    def tokens(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[int], list[int]]:
        """Ids by both of all texts, and their numbers; none where the text is null or empty, or the bytes of either differ from those of the text."""
        some = [i for i, t in enumerate(texts) if t]
        found: list[tuple[list[int], list[int]]] = [([], [])] * len(texts)
        for i, b in zip(some, self.b.encode([texts[i] for i in some]), strict=True):
            text = " " + texts[i]
            a, covered = self.a.encode(text), text.encode()
            if self.a.fast.decode_bytes(a) == covered and b"".join(map(self.b.pieces.__getitem__, b)) == covered:
                found[i] = (a, b)
        sizes = [[len(f[k]) for f in found] for k in (0, 1)]
        a, b = (np.fromiter(chain.from_iterable(f[k] for f in found), np.int32, sum(sizes[k])) for k in (0, 1))
        return a, b, *sizes

    def windows(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the windows of ids that cover the same bytes, and the index in ``a`` that each starts at."""
        found = Groups(a.astype(np.int64), b.astype(np.int64), self.a_lengths, self.b_lengths)
        # A verified anchor is a shared end before a token that starts with a space, or the end of all.
        anchor = np.append(self.spaced[a], True)[found.at_a]
        ends_a, ends_b = found.at_a[anchor], found.at_b[anchor]
        first, same = alike([(found.a, ends_a), (found.b, ends_b)])
        starts_a, starts_b = (np.concatenate([[0], ends[:-1]]) for ends in (ends_a, ends_b))
        # Tuples of ids as their bytes: four for an id.
        raw_a, raw_b, known, fresh, numbers = a.tobytes(), b.tobytes(), self.known, [], []
        for i, x, j, y in zip(*((4 * at[first]).tolist() for at in (starts_a, ends_a, starts_b, ends_b)), strict=True):
            window = raw_a[i:x] + BETWEEN + raw_b[j:y]
            number = known.get(window)
            if number is None:
                number = known[window] = len(known)
                fresh.append((raw_a[i:x], raw_b[j:y]))
            numbers.append(number)
        if fresh:
            self._learn(fresh)
        return np.array(numbers, np.int64)[same], starts_a

    def block(self, texts: pa.Array) -> dict:
        """Counts and groups of each text, and the distinct id pairs of the block."""
        if self.ids > MEMO_IDS:
            self.forget()
        n_a, n_b, digests, parts = [], [], [], []
        for start, stop in slices(texts, STEP_BYTES):
            a, b, own, other = self.tokens(texts.slice(start, stop - start).to_pylist())
            n_a.extend(own)
            n_b.extend(other)
            found, first = self.windows(a, b) if len(a) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            # Each text starts with a space, so its start is an anchor.
            ends = np.searchsorted(first, np.cumsum(own))
            named, i = list(map(self.texts.__getitem__, found.tolist())), 0
            for j in ends.tolist():
                digests.append(sha256(";".join(named[i:j]).encode()).hexdigest() if j > i else "")
                i = j
            parts.append((*self._sums(found, ends), *self._pairs(found, ends, start)))
        n_groups, n_links, owner, pairs, times = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (list(zip(*parts, strict=True)) or [()] * 5))
        keys, pair = np.unique(pairs, return_inverse=True)
        return {
            "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "groups_sha256": digests, "n_pairs": np.bincount(owner, minlength=len(texts)),
            "pair": pair.astype(np.int32), "times": times.astype(np.min_scalar_type(times.max(initial=0))),
            "keys": keys // self.kinds_b << SHIFT | keys % self.kinds_b, "holders": np.bincount(pair, minlength=len(keys)),
        }

    def _sums(self, found: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Groups and links of each text, whose windows end at ``ends``."""
        until = np.concatenate([[0], ends])
        return tuple(np.diff(np.concatenate([[0], np.cumsum(values[found])])[until]) for values in (self.n_groups, self.n_links))

    def _pairs(self, found: np.ndarray, ends: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct pairs of each text, in order: the text's number from ``start`` on, the pair, and its times."""
        begin, size = (np.cumsum(self.n_pairs) - self.n_pairs)[found], self.n_pairs[found]
        row = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
        kinds = len(self.a.pieces) * self.kinds_b
        code = np.repeat(np.repeat(np.arange(len(ends)) * kinds, np.diff(ends, prepend=0)), size) + self.pairs[row]
        times = self.times[row]
        if (times == 1).all():
            code.sort()
            new = np.flatnonzero(np.diff(code, prepend=-1))
            times = np.diff(np.append(new, len(code)))
        else:
            order = np.argsort(code)
            code, times = code[order], times[order].astype(np.int64)
            new = np.flatnonzero(np.diff(code, prepend=-1))
            times = np.add.reduceat(times, new)
        owner, pairs = np.divmod(code[new], kinds)
        return owner + start, pairs, times


COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_pairs"]
LISTS = ["keys", "holders"]
#: Of each document's pairs, one after the other: the place in ``keys``, 32 bits, and the times, as many bytes for each as the block's highest takes.
PACKED = ["pair", "times"]


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str, block_bytes: int | None = None) -> DataFrame:
    """A row for each block of texts: its documents, their pairs, and the distinct pairs of the block. Written, so that block numbers stay."""
    id_type = docs.schema["doc_id"].dataType
    block_bytes = BLOCK_BYTES if block_bytes is None else block_bytes
    columns = [("block", "long"), ("doc_id", f"array<{id_type.simpleString()}>"), *((c, "array<long>") for c in COUNTS + LISTS), *((c, "binary") for c in PACKED), ("groups_sha256", "array<string>")]
    ids = to_arrow_type(id_type)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = None, TaskContext.get().partitionId() << SHIFT
        for batch in batches:
            for start, stop in slices(batch.column("text"), block_bytes):
                aligner = aligner or Aligner(path_a, path_b)
                found = aligner.block(batch.column("text").slice(start, stop - start))
                rows = [
                    pa.array([number]), pa.array([batch.column("doc_id").slice(start, stop - start).to_pylist()], pa.list_(ids)),
                    *(pa.array([found[c]], pa.list_(pa.int64())) for c in COUNTS + LISTS), *(pa.array([found[c].tobytes()], pa.binary()) for c in PACKED),
                    pa.array([found["groups_sha256"]], pa.list_(pa.string())),
                ]
                yield pa.record_batch(rows, [c for c, _ in columns])
                number += 1

    frame = docs.select("doc_id", "text").mapInArrow(scan, ", ".join(f"{c} {t}" for c, t in columns))
    return written(frame, "token-blocks", **{"parquet.block.row.count.limit": GROUP_BLOCKS})


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``key, a_id, b_id, n, is_best``: documents in which the ids are linked, and whether no other B id has more with this A id.

    An A id has at most as many rows as B has ids.
    """
    held = blocks.select(F.explode(F.arrays_zip("keys", "holders")).alias("p")).select(F.col("p.keys").alias("key"), F.col("p.holders").alias("holders"))
    counted = held.groupBy("key").agg(F.sum("holders").alias("n"))
    split = counted.select("key", F.shiftright("key", SHIFT).cast("int").alias("a_id"), F.col("key").bitwiseAND(F.lit((1 << SHIFT) - 1)).cast("int").alias("b_id"), "n")
    return split.withColumn("is_best", F.col("n") == F.max("n").over(Window.partitionBy("a_id")))


def align(docs: DataFrame, path_a: str, path_b: str, block_bytes: int | None = None) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for each row of ``docs`` (doc_id, text); other columns aren't read.

    A text after one space is encoded by both tokenizers without special tokens. Null and empty texts have no tokens, nor have those whose bytes either
    tokenizer changes (U+2581 becomes a space in B): zeros and ''. Groups are cut wherever tokens of both end; all A and B tokens of a group are linked.
    A pair of ids counts the rows of ``docs`` that hold it linked, repeated rows and ids each; ``n_best`` are the links whose pair has the highest
    count of its A id (ties included), ``count_sum`` is the sum of counts over links. ``groups_sha256`` digests ``a1,a2|b1;a3|b2,b3``.
    Memory follows ``BLOCK_BYTES`` or the longest text. An empty table gives an empty one.
    """
    bounded_batches(docs.sparkSession)
    blocks = aligned_blocks(docs, path_a, path_b, block_bytes)
    counts = written(pair_counts(blocks), "token-pairs")
    asked = blocks.select("block", F.posexplode("keys").alias("pos", "key"))
    told = asked.join(counts.select("key", "n", "is_best"), "key").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("pos", "n", "is_best"))).alias("told"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    columns = [("doc_id", id_type), *((c, "long") for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), ("groups_sha256", "string")]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = {c: batch.column(c).slice(i, 1).flatten() for c in batch.schema.names if c not in ("block", *PACKED)}
                pair, times = (batch.column(c)[i].as_buffer() for c in PACKED)
                plain = lambda c: one[c].to_numpy(zero_copy_only=False).astype(np.int64)  # noqa: B023, E731
                n, best = (one["told"].field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (1, 2))
                times = np.frombuffer(times, f"u{len(times) // max(1, len(pair) // 4) or 1}").astype(np.int64)
                pair = np.frombuffer(pair, np.int32)
                until = np.concatenate([[0], np.cumsum(plain("n_pairs"))])
                total = lambda per_link: np.diff(np.concatenate([[0], np.cumsum(per_link * times)])[until])  # noqa: B023, E731
                out = [one["doc_id"], *(one[c] for c in ("n_a", "n_b", "n_groups", "n_links")), pa.array(total(best[pair])), pa.array(total(n[pair])), one["groups_sha256"]]
                yield pa.record_batch(out, [c for c, _ in columns])

    joined = blocks.drop("keys", "holders").join(told, "block", "left")
    joined = joined.withColumn("told", F.coalesce("told", F.array().cast("array<struct<pos:int,n:bigint,is_best:boolean>>")))
    return joined.mapInArrow(sums, ", ".join(f"{c} {t}" for c, t in columns))
