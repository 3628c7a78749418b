"""Harmonic packing of token sequences.

A length belongs to the class of the smallest size ``capacity // k`` that holds
it; ``capacity // size`` pieces of a class fill one bin. Documents may be cut,
so each is cut into pieces that fit their class almost exactly, and classes
fill their bins independently of each other.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from strata.llm.common import checkpointed, running_number, with_package
from strata.llm.kernels import slices
from strata.llm.mixing import mix_columns, scheduled, stream_positions, taken

SLICE_BYTES = 1 << 20
CACHED_WORDS = 500_000
#: Documents next to each other in the mixture whose pieces are ranked in one task.
ORDERED_ROWS = 4096
#: A text made of these letters only has the same tokens as its blank-separated
#: words have by themselves: no letter changes or joins under normalisation, and
#: every blank is one that the tokenizer splits at.
_OTHER = re.compile("[^\t\n\r\x20-\x7eÀ-ÖØ-öø-įı-ňŊ-ž–—‘’“”…]")

#: The split pattern of the tokenizer file (a fixed value).
_PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


class Encoder:
    """Token ids of whole texts as little-endian 32-bit numbers.

    Words are encoded once and remembered, up to ``CACHED_WORDS``; then the
    memory starts anew, which costs time only. A word that is not one run of
    letters is put together from its pre-tokens, which are remembered too. Texts with any letter outside
    the plain set go to the tokenizer whole, and so do those with the string of
    an added token unless ``added_as_text``: it is one id then, as the tokenizer
    file has it, and else the ids of its letters.
    """

    def __init__(self, path: str, added_as_text: bool = True):
        from tokenizers import Tokenizer, normalizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = added_as_text
        # words come in small letters that no normalisation changes, so theirs is left out
        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = added_as_text
        self.plain.normalizer = normalizers.Sequence([])
        self.known: dict[str, bytes] = {}
        # in small letters, as words are looked up; the tokenizer itself decides on the case
        added = {t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()} - {""}
        self.added = [] if added_as_text else sorted(added)
        size = self.tokenizer.get_vocab_size()
        self.last = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])

    def _encode(self, texts: list[str], plain: bool = False) -> list[np.ndarray]:
        tokenizer = self.plain if plain else self.tokenizer
        return [np.asarray(e.ids, "<u4") for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        """Remember the ids of each word: those of its pre-tokens, by the tokenizer's own split pattern.

        New pre-tokens are encoded as texts of 1000 of them; ids that end a
        pre-token tell where it ends.
        """
        known = self.known
        letters = [w for w in words if w.isalpha()]  # such a word is one pre-token
        mixed = [w for w in words if not w.isalpha()]
        split = [_PRETOKEN.findall(w) for w in mixed]
        new = list(set(letters).union(*split).difference(known))
        ids = np.concatenate([np.zeros(0, "<u4"), *self._encode([" ".join(new[i : i + 1000]) for i in range(0, len(new), 1000)], True)])
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(new):  # the patterns differ on some word
            known.update(zip(words, (x.tobytes() for x in self._encode(words))))
            return
        at, data = [0, *(4 * ends).tolist()], ids.tobytes()
        known.update((w, data[a:b]) for w, a, b in zip(new, at, at[1:]))
        known.update((w, b"".join(map(known.__getitem__, own))) for w, own in zip(mixed, split))

    def _words(self, text: str) -> list[str] | None:
        """The words of a text that may be encoded word by word."""
        if _OTHER.search(text):
            return None
        small = text.lower()
        return None if any(t in small for t in self.added) else small.split()

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = [self._words(t) for t in texts]
        if len(self.known) > CACHED_WORDS:
            self.known = {}
        known = self.known
        new = list(set().union(*filter(None, split)).difference(known))
        for at in range(0, len(new), 50_000):
            self._learn(new[at : at + 50_000])
        whole = iter(self._encode([t for t, words in zip(texts, split) if words is None]))
        return [next(whole).tobytes() if words is None else b"".join(map(known.__getitem__, words)) for words in split]


@lru_cache(maxsize=2)
def encoder(path: str, added_as_text: bool = True) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
    return Encoder(path, added_as_text)


@lru_cache(maxsize=4)
def class_sizes(capacity: int) -> list[int]:
    """All sizes ``capacity // k``, ascending."""
    return sorted({capacity // k for k in range(1, capacity + 1)})


def cut(tokens: int, capacity: int, slack: float) -> list[tuple[int, int]]:
    """Pieces (length, class size) of a document of ``tokens`` tokens.

    Whole capacities first. The rest goes whole into the class that holds it if
    it fills the class up to ``slack``; else the largest class size below it is
    cut off and the remainder goes on the same way.
    """
    sizes = class_sizes(capacity)
    out = [(capacity, capacity)] * (tokens // capacity)
    rest = tokens % capacity
    while rest:
        at = bisect_left(sizes, rest)
        if rest >= sizes[at] * (1 - slack):
            out.append((rest, sizes[at]))
            break
        out.append((sizes[at - 1], sizes[at - 1]))
        rest -= sizes[at - 1]
    return out


def pieces(
    docs: DataFrame, tokenizer: str, *, end_id: int = 2, capacity: int = 4096, slack: float = 1 / 128, with_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, added_as_text: bool = True,
) -> DataFrame:
    """Tokenize and cut: doc_id, start, length, ids_crc32, doc_tokens, size, ids if asked for, and the ``keep`` columns.

    Row by row, without a shuffle. A null text is empty: its only token is ``end_id``.
    """
    keep = keep or []
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), *keep)
    with_package(docs.sparkSession)
    schema = StructType([
        rows.schema["doc_id"], StructField("start", LongType()), StructField("length", LongType()),
        StructField("ids_crc32", LongType()), StructField("doc_tokens", LongType()), StructField("size", IntegerType()),
        *([StructField("ids", BinaryType())] if with_ids else []), *[rows.schema[c] for c in keep],
    ])
    stop = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, added_as_text)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                row, start, length, crc, whole, size, ids = [], [], [], [], [], [], []
                for i, data in enumerate(encode([t or "" for t in part.column("text").to_pylist()])):
                    data += stop
                    n, at, view = len(data) // 4, 0, memoryview(data)
                    for piece, kind in cut(n, capacity, slack):
                        own = view[4 * at : 4 * (at + piece)]
                        row.append(i), start.append(at), length.append(piece), crc.append(zlib.crc32(own))
                        whole.append(n), size.append(kind)
                        if with_ids:
                            ids.append(bytes(own))
                        at += piece
                columns = [
                    part.column("doc_id").take(pa.array(row, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()), pa.array(whole, pa.int64()), pa.array(size, pa.int32()),
                ]
                columns += [pa.array(ids, pa.binary())] if with_ids else []
                columns += [part.column(c).take(pa.array(row, pa.int64())) for c in keep]
                yield pa.RecordBatch.from_arrays(columns, schema=None, names=schema.names)

    return rows.mapInArrow(run, schema)


def _best_fit(capacity: int):
    """Fill bins with the pieces left over, longest first, each into the fullest bin that holds it."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        free: list[tuple[int, int]] = []
        bins, offsets, made = [], [], 0
        for n in rows.column("length").to_pylist():
            at = bisect_left(free, (n, -1))
            if at < len(free):
                room, which = free.pop(at)
            else:
                room, which, made = capacity, made, made + 1
            bins.append(which)
            offsets.append(capacity - room)
            if room > n:
                insort(free, (room - n, which))
        return rows.append_column("__bin", pa.array(bins, pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

    return run


def harmonic_pack(
    docs: DataFrame, tokenizer: str, *, end_id: int = 2, capacity: int = 4096, slack: float = 1 / 128, with_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text", weights: dict[str, int] | None = None, source_col: str = "source",
    added_as_text: bool = True,
) -> DataFrame:
    """Pack whole documents into sequences of at most ``capacity`` tokens.

    Returns one row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id (gapless from 0), offset, and with ``with_ids`` the piece's
    little-endian 32-bit ids.

    Pieces are numbered inside their class by running offsets over hash buckets,
    so a class with most pieces spreads over all tasks; number and class give
    the bin. Only pieces that fill no whole bin of their class, fewer than
    ``capacity // size`` of each class and so bounded by ``capacity`` alone,
    meet in one task, which fills bins best-fit.

    With ``weights`` (as of ``mix_sources``) pieces are numbered in the order of
    the mixture, worked out anew from the weights and the rows, so it does not
    hang on the order of the input; so each bin holds pieces that are next to
    each other in their class, and sequences are numbered by their first pieces.
    The texts do not move for that.

    Strings of the tokenizer's added tokens are ids of letters; without
    ``added_as_text`` they are the tokens' own ids, the tokenizer file's default.

    Null and empty texts are documents of one token; a text of any length is
    tokenized whole by one task and cut into as many pieces as it needs. Repeated rows are packed
    like any others. An empty table gives no rows; other columns are not read.
    """
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else [])]
    place: list[str] = []
    if weights is not None:
        place = ["__row", "mix_class", "mix_size", "__mix_check", "__mix_id"]
        clear = docs.drop(*taken(docs))
        docs = clear.withColumns({"__row": F.monotonically_increasing_id(), **mix_columns(weights, id_col, source_col, text_col)})
    cutup = checkpointed(pieces(
        docs, tokenizer, end_id=end_id, capacity=capacity, slack=slack, with_ids=with_ids, id_col=id_col, text_col=text_col, keep=place,
        added_as_text=added_as_text,
    ))
    if weights is not None:
        order = stream_positions(scheduled(cutup.filter("start = 0").select(*place), weights), weights).select("__row", "mix_position")
        cutup = checkpointed(cutup.drop(*place[1:]).join(order, "__row").drop("__row"))
    # one row per class, at most 2 * sqrt(capacity) of them
    count = {r["size"]: r["count"] for r in cutup.groupBy("size").count().collect()}
    base, full, made = {}, {}, 0
    for size in sorted(count, reverse=True):
        per = capacity // size
        base[size], full[size] = made, count[size] // per * per
        made += count[size] // per
    if not count:
        return cutup.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).select(names)
    table = lambda values: F.element_at(F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.lit(v).cast("long"))]), F.col("size"))
    near = lambda c: F.call_function("div", F.col(c), F.lit(ORDERED_ROWS).cast("long"))
    if weights is None:
        rows = running_number(cutup, ["doc_id", "start", "ids_crc32"], "__rank", within=["size"])
    else:
        rows = running_number(cutup, ["mix_position", "start"], "__rank", within=["size"], bucket=near("mix_position"))
    rows = rows.withColumn("__full", F.col("__rank") < table(full))
    per = F.call_function("div", F.lit(capacity).cast("long"), F.col("size").cast("long"))
    before = W.partitionBy("sequence_id").orderBy("__rank").rowsBetween(W.unboundedPreceding, -1)
    own = rows.filter("__full").withColumn("sequence_id", table(base) + F.call_function("div", F.col("__rank"), per))
    own = own.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    rest = rows.filter("not __full").select(*cutup.columns)
    late = rest.groupBy(F.lit(0).alias("__all")).applyInArrow(
        _best_fit(capacity), StructType([*rest.schema.fields, StructField("__bin", LongType()), StructField("offset", LongType())])
    )
    late = late.withColumn("sequence_id", F.col("__bin") + made)
    if weights is None:
        return own.select(names).union(late.select(names))
    packed = checkpointed(own.select(*names, "mix_position").union(late.select(*names, "mix_position")))
    first = packed.groupBy("sequence_id").agg(F.min(F.struct("mix_position", "start")).alias("__first")).select("sequence_id", "__first.*")
    turn = running_number(first, ["mix_position", "start"], "__turn", bucket=near("mix_position")).select("sequence_id", "__turn")
    return packed.join(turn, "sequence_id").withColumn("sequence_id", F.col("__turn")).select(names)
