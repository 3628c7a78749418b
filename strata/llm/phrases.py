"""Collocations from depth-truncated suffix subtrees over groups of word prefixes.

Vertical partitioning in the manner of ERA: the suffixes of the corpus, one per
word occurrence and cut after ``max_words`` words, are parted by their first
words into groups that fit a memory budget. A word with more occurrences than
the budget is no prefix of a group by itself; its suffixes are parted by their
second word as well, and by the third where that one is too frequent too. Each
group sorts its suffixes, which is its part of the suffix tree, and reads the
count of every phrase from the totals of the leaves below it.

Words are compared as texts and numbered by a join, phrases are compared by
these numbers: no count rests on a hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm.common import checkpointed, fresh, running_number, with_package

SPACES, BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"
_KIND = np.zeros(256, np.uint8)
_KIND[list(SPACES)], _KIND[list(BREAKS)] = 1, 2
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_CODEC = "zstd"
_CHUNK = "chunk long, lang string, n_words long, words array<string>, counts array<long>, sequence binary, n_sequence long"


def slices(text: bytes, limit: int) -> Iterator[bytes]:
    """The text in parts of at most ``limit`` bytes, cut after piece breaks only (a longer piece stays whole)."""
    start = 0
    while len(text) - start > limit:
        cut = max(text.rfind(c, start, start + limit) for c in [BREAKS[i : i + 1] for i in range(len(BREAKS))]) + 1
        if not cut:
            later = np.flatnonzero(_KIND[np.frombuffer(text, np.uint8, offset=start)] == 2)
            cut = start + int(later[0]) + 1 if len(later) else len(text)
        yield text[start:cut]
        start = cut
    if start < len(text):
        yield text[start:]


def encode(text: bytes) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of a text, and the text as their places there, -1 between pieces."""
    raw = np.frombuffer(text.translate(_LOWER), np.uint8)
    kind = _KIND[raw]
    inside = kind == 0
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.zeros(len(start) + 1, np.int32)
    np.cumsum(end - start, out=offsets[1:])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw[inside]))]
    coded = pa.Array.from_buffers(pa.string(), len(start), buffers).dictionary_encode()
    piece = np.searchsorted(np.flatnonzero(kind == 2), start)
    places = np.asarray(coded.indices, np.int32)
    return coded.dictionary, np.insert(places, np.flatnonzero(np.diff(piece)) + 1, -1)


def suffixes(ids: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct suffixes of at least two numbered words, cut after ``depth``, as sorted rows; and their counts.

    Number 0 (a break or a word too rare for any phrase) ends a suffix; it fills the rest of its row.
    """
    padded = np.concatenate([ids, np.zeros(depth, np.int64)])
    columns = [padded[: len(ids)]]
    for k in range(1, depth):
        columns.append(np.where(columns[-1] > 0, padded[k : k + len(ids)], 0))
    rows = np.stack(columns, 1)[columns[1] > 0]
    return totals(rows, np.ones(len(rows), np.int64))


def totals(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows summed up, in sorted order."""
    if not len(rows):
        return rows, counts
    order = np.lexsort(rows.T[::-1])
    rows, counts = rows[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(1)]))
    return rows[first], np.add.reduceat(counts, first)


def nodes(rows: np.ndarray, counts: np.ndarray, known: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per depth from 2: the phrases of a subtree and their counts, read from sorted distinct suffixes.

    Phrases of ``known`` words or more have all of their suffixes here and are
    left out below ``least``; shorter ones have suffixes in other groups too.
    """
    for depth in range(2, rows.shape[1] + 1):
        deep = rows[:, depth - 1] > 0
        head, count = rows[deep, :depth], counts[deep]
        if not len(head):
            return
        first = np.flatnonzero(np.concatenate([[True], (head[1:] != head[:-1]).any(1)]))
        total = np.add.reduceat(count, first)
        keep = total >= least if depth >= known else np.ones(len(total), bool)
        yield head[first][keep], total[keep]


def _mixed(columns: np.ndarray) -> np.ndarray:
    """A hash of each row, to deal suffixes by."""
    out = np.zeros(len(columns), np.uint64)
    for column in columns.T:
        out = (out ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def prefix_groups(rows: np.ndarray, seen: np.ndarray, budget: int) -> np.ndarray:
    """(group, words of the prefix, part) of each suffix; ``seen`` holds how often each of its words occurs.

    A word's number is one more than the occurrences of all words before it, so
    the words of one group are those whose numbers fall into one budget. A word
    above the budget is parted by the words up to the first that is not.
    """
    depth = rows.shape[1]
    hot = seen > budget
    ends = np.where(hot.all(1), depth, hot.argmin(1) + 1)
    part = np.zeros(len(rows), np.int64)
    for words in range(2, depth + 1):
        mine = ends == words
        parts = -(-seen[mine, 0] // budget)
        part[mine] = (_mixed(rows[mine, 1:words]) % parts.astype(np.uint64)).astype(np.int64)
    return np.stack([rows[:, 0] // budget, ends, part], 1)


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values), codec=_CODEC, asbytes=True)


def _unpacked(data: bytes, count: int, kind=np.int64) -> np.ndarray:
    size = count * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(data, decompressed_size=size, codec=_CODEC, asbytes=True), kind) if size else np.zeros(0, kind)


def _chunks(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """Texts of one language, gathered to about ``chunk_bytes`` in each task, as numbered words."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}
        number = TaskContext.get().partitionId() << 32

        def flush(lang: str) -> pa.RecordBatch:
            nonlocal number
            words, sequence = encode(b"\n".join(held.pop(lang)))
            del size[lang]
            counts = np.bincount(sequence[sequence >= 0], minlength=len(words))
            row = [number, lang, int(counts.sum()), words, pa.array(counts), _packed(sequence), len(sequence)]
            number += 1
            types = [pa.int64(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary(), pa.int64()]
            lists = {3: pa.string(), 4: pa.int64()}
            arrays = [
                pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v.cast(lists[i])) if i in lists else pa.array([v], types[i])
                for i, v in enumerate(row)
            ]
            return pa.RecordBatch.from_arrays(arrays, names=["chunk", "lang", "n_words", "words", "counts", "sequence", "n_sequence"])

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                for part in slices(text.as_py(), chunk_bytes):
                    held.setdefault(lang, []).append(part)
                    size[lang] = size.get(lang, 0) + len(part) + 1
                    if size[lang] >= chunk_bytes:
                        yield flush(lang)
                    elif sum(size.values()) >= 4 * chunk_bytes:
                        yield flush(max(size, key=size.get))
        for lang in list(held):
            yield flush(lang)

    return docs.mapInArrow(gather, _CHUNK)


def mine_phrases(
    docs: DataFrame, *, max_words: int = 3, min_count: int = 10, top: int = 2000, share: int = 50,
    text_col: str = "text", lang_col: str = "lang", budget: int = 1 << 21, chunk_bytes: int = 1 << 23,
) -> DataFrame:
    """Per language the ``top`` phrases of 2 to ``max_words`` words: lang, rank, phrase, a, l, r, n, score.

    ``a`` is how often the phrase occurs (at least ``min_count`` times), ``l`` and
    ``r`` how often its two parts do at the cut with the lowest score
    floor(10^6 a a / (l r)) (ties to the earlier cut), ``n`` the words of the
    language. A phrase goes if a longer one of at least ``min_count`` holds it and
    occurs at least ``share`` percent as often. Order: score, then a, both falling,
    then the phrase in byte order. Words and pieces are those of the module;
    only A-Z are lower-cased.

    Null texts count as empty, null languages as ``und``; texts without words,
    empty tables and languages without phrases give no rows. Repeated rows are
    further occurrences. Very long texts are worked in parts cut at piece breaks;
    a single piece is never parted, so it must fit a task. Other columns are not
    read.

    ``budget`` is the number of suffixes a group may hold (before equal ones are
    summed up), ``chunk_bytes`` the text that is numbered together. Suffixes are
    summed up in their chunk before they are dealt, so a passage in a third of
    all documents is one row of a chunk. Only the numbers of languages and chunks
    stay small by themselves; nothing is collected.
    """
    spark = docs.sparkSession
    with_package(spark)
    plain = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("text")
    ).filter(F.length("text") > 0)
    chunks = checkpointed(_chunks(plain, chunk_bytes))
    entries = chunks.select("chunk", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w")).select(
        "chunk", "lang", "place", F.col("w.words").alias("word"), F.col("w.counts").alias("n")
    )
    # words below min_count are in no phrase; a word's number tells its group
    frequent = checkpointed(entries.groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= min_count))
    vocabulary = checkpointed(
        running_number(frequent, ["lang", "word"], "id", weight="f").select("lang", "word", "f", (F.col("id") + 1).alias("id"))
    )
    numbers = entries.join(fresh(vocabulary), ["lang", "word"]).select("chunk", "place", "id", "f")

    def deal(chunk: pa.Table, known: pa.Table) -> pa.Table:
        out: list[tuple] = []
        for row in chunk.to_pylist():
            sequence = _unpacked(row["sequence"], row["n_sequence"], np.int32)
            many = int(sequence.max(initial=-1)) + 1
            place = np.asarray(known.column("place"), np.int64)
            number = np.zeros(many + 1, np.int64)  # the last one answers for -1
            number[place] = np.asarray(known.column("id"))
            rows, counts = suffixes(number[sequence], max_words)
            by = np.argsort(number)
            seen = np.zeros(many + 1, np.int64)
            seen[place] = np.asarray(known.column("f"))
            keys = prefix_groups(rows, seen[by][np.searchsorted(number[by], rows)], budget)
            order = np.lexsort(keys.T[::-1])
            rows, counts, keys = rows[order], counts[order], keys[order]
            cuts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)])) if len(keys) else np.zeros(0, int)
            for a, b in zip(cuts, [*cuts[1:], len(keys)]):
                block = np.concatenate([rows[a:b].T.ravel(), counts[a:b]])  # column by column: close numbers side by side
                out.append((*map(int, keys[a]), b - a, _packed(block)))
        columns = list(zip(*out)) if out else [()] * 5
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["g", "known", "part", "n", "suffixes"])

    dealt = (
        chunks.select("chunk", "sequence", "n_sequence").groupBy("chunk").cogroup(fresh(numbers).groupBy("chunk"))
        .applyInArrow(deal, "g long, known long, part long, n long, suffixes binary")
    )

    def subtree(key: tuple, group: pa.Table) -> pa.Table:
        blocks = []
        for n, data in zip(group.column("n").to_pylist(), group.column("suffixes").to_pylist()):
            blocks.append(_unpacked(data, n * (max_words + 1)).reshape(max_words + 1, n))
        merged = np.concatenate(blocks, 1)
        rows, counts = totals(merged[:max_words].T, merged[max_words])
        phrases, found = [], []
        for words, total in nodes(rows, counts, key[1].as_py(), min_count):
            phrases += words.tolist()
            found += total.tolist()
        return pa.table([pa.array(phrases, pa.list_(pa.int64())), pa.array(found, pa.int64())], names=["phrase", "f"])

    parts = dealt.groupBy("g", "known", "part").applyInArrow(subtree, "phrase array<long>, f long")
    counted = parts.groupBy("phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= min_count)
    counts = checkpointed(counted.union(vocabulary.select(F.array("id"), "f")))
    return _ranked(counts, vocabulary, chunks.groupBy("lang").agg(F.sum("n_words").alias("n")), top, share)


def _ranked(counts: DataFrame, vocabulary: DataFrame, sizes: DataFrame, top: int, share: int) -> DataFrame:
    """Score the counted phrases, drop those inside longer ones, and rank what is left per language."""
    phrases = counts.filter(F.size("phrase") > 1).withColumnRenamed("f", "a")
    length = F.size("phrase")
    cuts = phrases.select("phrase", "a", F.explode(F.sequence(F.lit(1), length - 1)).alias("cut")).select(
        "phrase", "a", "cut", F.slice("phrase", F.lit(1), F.col("cut")).alias("head"), F.expr("slice(phrase, cut + 1, size(phrase) - cut)").alias("tail")
    )
    part = lambda name, f: counts.select(F.col("phrase").alias(name), F.col("f").alias(f))
    wide = lambda c: f"CAST({c} AS DECIMAL(19, 0))"
    scored = cuts.join(part("head", "l"), "head").join(part("tail", "r"), "tail").withColumn(
        "score", F.expr(f"(CAST(1000000 AS DECIMAL(7, 0)) * ({wide('a')} * {wide('a')})) DIV ({wide('l')} * {wide('r')})")
    )
    lowest = scored.groupBy("phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("best"))

    # every shorter phrase inside a phrase, with the count of the most frequent phrase around it
    inner = phrases.filter(length > 2).select(
        F.col("a").alias("longer"),
        F.explode(F.expr(
            "flatten(transform(sequence(2, size(phrase) - 1), w -> transform(sequence(1, size(phrase) - w + 1), s -> slice(phrase, s, w))))"
        )).alias("phrase"),
    ).groupBy("phrase").agg(F.max("longer").alias("longer"))
    inside = F.col("longer").cast("decimal(19,0)") * 100 >= F.col("a").cast("decimal(19,0)") * share
    kept = lowest.join(inner, "phrase", "left").filter(~F.coalesce(inside, F.lit(False)))

    words = kept.select("phrase", F.posexplode("phrase").alias("at", "id")).join(vocabulary.select("id", "lang", "word"), "id")
    texts = words.groupBy("phrase").agg(F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w"))
    named = kept.join(texts, "phrase").select(
        "lang", F.concat_ws(" ", F.col("w.word")).alias("phrase"), "a", "best.l", "best.r", "best.score"
    )
    order = W.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    long = lambda c: F.col(c).cast("long").alias(c)
    return ranked.join(sizes, "lang").select("lang", long("rank"), "phrase", *[long(c) for c in ("a", "l", "r", "n", "score")])
