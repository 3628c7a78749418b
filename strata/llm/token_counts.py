"""Token counts by a linear longest-match automaton.

The vocabulary is a trie over symbols; every node has a failure link and the
number of pieces that are popped when it is followed. One pass over a word
counts its greedy longest-match pieces without building any of them.

A symbol is a byte, or 256 + byte for a word's last byte, so that pieces which
carry the end-of-word mark match only there. Every single symbol is a piece of
the vocabulary, so no word gets stuck.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from strata.llm.common import with_package
from strata.llm.kernels import Words, slices, texts_of

END = "</w>"
SYMBOLS = 512
SLICE_BYTES = 2 << 20
#: Words longer than this are walked one by one instead of side by side.
LONG_WORD = 256


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Printable Latin-1 bytes stand for themselves; the others, in order, are the
    letters from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def symbols(piece: str, letters: dict[str, int]) -> list[int]:
    final = piece.endswith(END)
    out = [letters[c] for c in (piece[: -len(END)] if final else piece)]
    if final and out:
        out[-1] += 256
    return out


class Automaton:
    """Trie with failure links and popped-piece counts."""

    def __init__(self, pieces: list[list[int]]):
        nxt: dict[int, int] = {}
        parent, symbol, terminal = [0], [0], [False]
        for piece in [*([s] for s in range(SYMBOLS)), *pieces]:
            at = 0
            for c in piece:
                key = at * SYMBOLS + c
                at = nxt.get(key, -1)
                if at < 0:
                    at = nxt[key] = len(parent)
                    parent.append(key // SYMBOLS)
                    symbol.append(c)
                    terminal.append(False)
            if piece:
                terminal[at] = True
        fail, pops = [0] * len(parent), [0] * len(parent)
        for v in self._by_depth(parent):
            if terminal[v]:
                pops[v] = 1  # the node's own piece; matching starts anew
                continue
            # its parent's pops, then whatever must go until the symbol fits
            z, n = fail[parent[v]], pops[parent[v]]
            while (to := nxt.get(z * SYMBOLS + symbol[v], -1)) < 0:
                n += pops[z]
                z = fail[z]
            fail[v], pops[v] = to, n
        keys = np.fromiter(nxt, np.int64, len(nxt))
        order = np.argsort(keys)
        self.keys, self.to = keys[order], np.fromiter(nxt.values(), np.int64, len(nxt))[order]
        self.fail, self.pops, self.next = np.array(fail), np.array(pops), nxt

    @staticmethod
    def _by_depth(parent: list[int]) -> list[int]:
        depth = np.zeros(len(parent), np.int64)
        for v in range(1, len(parent)):  # parents come first
            depth[v] = depth[parent[v]] + 1
        return np.argsort(depth, kind="stable")[1:].tolist()

    def count_one(self, word: list[int]) -> int:
        s = n = 0
        for c in word:
            while (to := self.next.get(s * SYMBOLS + c, -1)) < 0:
                n += int(self.pops[s])
                s = int(self.fail[s])
            s = to
        while s:
            n += int(self.pops[s])
            s = int(self.fail[s])
        return n

    def count(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Pieces of each word buf[start:end], all words stepped side by side."""
        length = end - start
        state = np.zeros(len(start), np.int64)
        total = np.zeros(len(start), np.int64)
        order = np.argsort(-length, kind="stable")
        long = int(np.searchsorted(-length[order], -LONG_WORD, "left"))
        for w in order[:long].tolist():
            word = buf[start[w] : end[w]].astype(np.int64)
            word[-1] += 256
            total[w] = self.count_one(word.tolist())
        order = order[long:]
        ranked = length[order]
        for k in range(int(ranked[0]) if len(order) else 0):
            live = order[: np.searchsorted(-ranked, -k, "left")]
            c = buf[start[live] + k].astype(np.int64) + 256 * (length[live] == k + 1)
            todo, sym = live, c
            while len(todo):
                key = state[todo] * SYMBOLS + sym
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = self.keys[at] == key
                state[todo[hit]] = self.to[at[hit]]
                todo, sym = todo[~hit], sym[~hit]
                total[todo] += self.pops[state[todo]]
                state[todo] = self.fail[state[todo]]
        todo = order[state[order] > 0]
        while len(todo):
            total[todo] += self.pops[state[todo]]
            state[todo] = self.fail[state[todo]]
            todo = todo[state[todo] > 0]
        return total


@lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    """The automaton of a byte-level vocabulary file, once per worker."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    letters = byte_letters()
    return Automaton([symbols(p, letters) for p in vocab])


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Greedy longest-match piece counts of whole texts: doc_id, n_words, n_tokens.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 bytes, A-Z lower-cased.
    ``vocabulary`` is the path of a byte-level tokenizer file that every
    executor has. Null and empty texts have 0 words and tokens; rows are handled
    one by one (no shuffle), so repeated rows and ids stay as they are, and an
    empty table gives no rows. Other columns are not read.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    with_package(docs.sparkSession)
    schema = StructType([rows.schema["doc_id"], StructField("n_words", LongType()), StructField("n_tokens", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(vocabulary)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                words = Words(texts_of(part, "text"))
                # each distinct word of the slice is counted once
                _, first, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
                counts = machine.count(words.buf, words.start[first], words.end[first])[which]
                upto = np.r_[0, np.cumsum(counts)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(words.last - words.first, pa.int64()), pa.array(upto[words.last] - upto[words.first], pa.int64())],
                    names=["doc_id", "n_words", "n_tokens"],
                )

    return rows.mapInArrow(run, schema)
