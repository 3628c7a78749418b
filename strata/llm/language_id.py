"""Language identification by multilingual mixture inference.

Each language is a distribution over hashed letter trigrams. A document's
language proportions come from expectation-maximisation over its trigram
counts, and the set of languages it is said to hold is the one of best
penalised likelihood.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strata.llm.common import with_package
from strata.llm.kernels import LOWER, slices

BITS = 15
SLICE_BYTES = 1 << 20
MAX_LANGUAGES = 1000
_LETTER = re.compile(r"[^\W\d_]")
#: Bytes that are no part of a word become blanks; A-Z become a-z.
_FOLD = LOWER.copy()
_FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 32


def gram_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct trigrams of each text: (text number, hashed gram, count), by text.

    Grams are three bytes around a byte of a word, so blanks appear at word ends only.
    """
    buf = _FOLD[np.frombuffer(b"  " + b"  ".join(texts) + b"  ", np.uint8)]
    begin = np.cumsum([2, *(len(t) + 2 for t in texts)])
    mid = np.flatnonzero(buf[1:-1] != 32) + 1
    code = (buf[mid - 1].astype(np.uint32) << 16) | (buf[mid].astype(np.uint32) << 8) | buf[mid + 1]
    code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
    text = np.searchsorted(begin, mid, "right") - 1
    key, n = np.unique((text.astype(np.int64) << BITS) | code, return_counts=True)
    return key >> BITS, key & ((1 << BITS) - 1), n


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Trigram counts of every labelled text: lang, gram, n. Pre-aggregated in each task."""
    with_package(labelled.sparkSession)
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).filter("lang is not null and text is not null")
    schema = StructType([StructField("lang", StringType()), StructField("gram", LongType()), StructField("n", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                langs = part.column("lang").to_pylist()
                text, gram, n = gram_counts(part.column("text").cast(pa.binary()).to_pylist())
                names = sorted(set(langs))
                code = np.array([names.index(x) for x in langs])
                both = np.bincount((code[text] << BITS) | gram, n, len(names) << BITS).reshape(len(names), -1).astype(np.int64)
                for name, row in zip(names, both):
                    sums[name] = sums[name] + row if name in sums else row
        for name, row in sums.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(row[at])], names=["lang", "gram", "n"])

    return rows.mapInArrow(run, schema).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Mixture:
    """Languages and their smoothed gram probabilities."""

    def __init__(self, counts: DataFrame, smooth: float = 0.5):
        langs = [r["lang"] for r in counts.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()]
        if len(langs) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages")
        self.langs = sorted(langs)
        table = np.full((len(langs), 1 << BITS), smooth)
        if langs:  # at most languages * 2**BITS rows
            rows = counts.toPandas()
            table[np.searchsorted(self.langs, rows["lang"].to_numpy(str)), rows["gram"].to_numpy()] += rows["n"].to_numpy()
        self.p = (table / table.sum(1, keepdims=True)).T.astype(np.float32).copy() if langs else np.zeros((1 << BITS, 0), np.float32)

    def proportions(self, texts: list[bytes], rounds: int = 12, penalty: float = 3.0, least: float = 0.01) -> np.ndarray:
        """Per text the proportions of its languages, 0 for those not selected.

        EM over all languages first. Languages are then taken away, the smallest
        proportion first, as long as the likelihood pays more in penalty
        (``penalty`` nats times the log of the gram count) than it loses.
        """
        if not texts or not self.langs:
            return np.zeros((len(texts), len(self.langs)))
        text, gram, n = gram_counts(texts)
        k = len(self.langs)
        out = np.zeros((len(texts), k))
        if not len(text):
            return out
        first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
        who, size = text[first], np.add.reduceat(n, first)
        local = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(text)]))
        p, w = self.p[gram], n.astype(np.float32)

        def fit(rows: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Proportions and log likelihood of some texts, each over its allowed languages."""
            take = np.isin(local, rows) if len(rows) < len(first) else slice(None)
            pp, ww = p[take], w[take]
            at = np.searchsorted(rows, local[take])
            cut = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            pi = (allowed / allowed.sum(1, keepdims=True)).astype(np.float32)
            total = size[rows].astype(np.float32)[:, None]
            for _ in range(rounds):
                r = pi[at] * pp
                r *= (ww / r.sum(1))[:, None]
                pi = np.add.reduceat(r, cut) / total
            return pi, np.add.reduceat(ww * np.log((pi[at] * pp).sum(1)), cut, dtype=np.float64)

        rows = np.arange(len(first))
        allowed = np.ones((len(rows), k), bool)
        pi, like = fit(rows, allowed)
        best, cost = pi.copy(), penalty * np.log(size + 1.0)
        # one step for languages that hold next to nothing, then one language at a time
        live = rows
        for step in range(k):
            if step == 0:
                keep = (best >= least) | (best == best.max(1, keepdims=True))
            else:
                keep = allowed[live].copy()
                small = np.where(keep, best[live], np.inf).argmin(1)
                keep[np.arange(len(live)), small] = False
            some = keep.sum(1) < allowed[live].sum(1)
            some &= keep.any(1)
            live, keep = live[some], keep[some]
            if not len(live):
                break
            pi, less = fit(live, keep)
            gone = allowed[live].sum(1) - keep.sum(1)
            good = less + gone * cost[live] >= like[live]
            live = live[good]
            best[live], like[live], allowed[live] = pi[good], less[good], keep[good]
        out[who] = np.where(allowed, best, 0)
        return out / np.maximum(out.sum(1, keepdims=True), 1e-12)


def fold(id_column: Column) -> Column:
    """crc32 of the id as text, modulo 4 (a null id counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")), F.lit(4))


def identify(docs: DataFrame, model: Mixture, keep: list[str], text_col: str = "text") -> DataFrame:
    """Add lang_pred, score, languages to the ``keep`` columns of every row.

    ``lang_pred`` is the language of the largest proportion and ``score`` that
    proportion; ties go to the first name. ``languages`` lists all selected
    ones. A text that is null or has no letter is ``und`` with score 0.
    """
    with_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    # an expression on the text alone: the text goes to the workers, only the answer comes back
    @F.arrow_udf(_JUDGED)
    def judged(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for column in texts:
            batch = pa.RecordBatch.from_arrays([column], names=["text"])
            parts = [_judge(model, part.column(0).to_pylist()) for part in slices(batch, "text", SLICE_BYTES)]
            yield pa.concat_arrays(parts) if parts else _judge(model, [])

    # not evaluated again below a filter on its result
    answer = judged.asNondeterministic()(F.col(text_col))
    out = docs.select(*[F.col(c) for c in keep], answer.alias("__judged"))
    return out.select(*keep, "__judged.lang_pred", "__judged.score", "__judged.languages")


_JUDGED = "lang_pred string, score double, languages string"


def _judge(model: Mixture, texts: list[str | None]) -> pa.StructArray:
    """lang_pred, score and languages of each text."""
    names = np.array([*model.langs, "und"], object)
    real = np.array([t is not None and bool(_LETTER.search(t)) for t in texts], bool)
    pi = model.proportions([t.encode() if ok else b"" for t, ok in zip(texts, real)])
    real &= pi.sum(1) > 0 if pi.shape[1] else False
    top = np.where(real, pi.argmax(1) if pi.shape[1] else 0, len(names) - 1)
    score = np.where(real, pi.max(1) if pi.shape[1] else 0.0, 0.0)
    also = [",".join(names[:-1][row > 0]) if ok else "" for row, ok in zip(pi, real)]
    return pa.StructArray.from_arrays(
        [pa.array(names[top].tolist(), pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(also, pa.string())],
        names=["lang_pred", "score", "languages"],
    )


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Mixture:
    """The mixture model of all labelled rows outside the held-out fold (``fold`` 2)."""
    return Mixture(train(docs.filter(fold(F.col(id_col)) != 2), text_col, lang_col))


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Predict the language of every row: doc_id, held_out, lang_pred, score, languages.

    Texts of any length are judged whole, each by one task.
    Null, empty and letterless texts are ``und``. Rows without a label are not
    learned from; without any labelled row every text is ``und``. Repeated rows
    count as often as they occur; an empty table gives no rows; other columns
    are not read.
    """
    model = learn(docs, id_col, text_col, lang_col)
    out = identify(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model, ["doc_id"])
    return out.select("doc_id", (fold(F.col("doc_id")) == 2).alias("held_out"), "lang_pred", "score", "languages")
