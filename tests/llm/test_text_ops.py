"""Token counts, packing, language ID, near-duplicates and repeats against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from strata.llm import kernels, language_id, minhash, packing, suffix_dedup, token_counts

VOCAB = public_tokenizers.path("word_bpe_49k.json")
SYL = ["tion", "the", "er", "an", "re", "on", "at", "en", "nd", "ti", "es", "or", "st", "ing"]


def words(rng, n):
    return ["".join(rng.choice(SYL) for _ in range(rng.randint(1, 3))) for _ in range(n)]


ODD = [
    None, "", " \t\n ", "a", "A b", "don't 'tis we've x's !'s 12ab “q”", "İstanbul ŉ ſ Σας ﬁ é", "\x1c a\x85b", "<|endoftext|> Ⅷ", "日本語 テスト",
    "ß Ä Ÿ ž × ÷ … — a—b it's", "x" * 3000, "one two three four", "ONE two three FOUR", "one two three four five", "\x0bv\x0cf",
]


# -------------------------------------------------------------- token counts
def greedy(text, pieces, longest):
    n = 0
    for w in (text or "").encode().lower().split():
        s = list(w)
        s[-1] += 256
        i = 0
        while i < len(s):
            i = next(j for j in range(min(len(s), i + longest), i, -1) if tuple(s[i:j]) in pieces)
            n += 1
    return n


def test_token_counts_equal_greedy_matching(spark, docs):
    rng = random.Random(2)
    texts = ODD + [" ".join(words(rng, rng.randint(1, 300))) for _ in range(40)] + ["the" * 2000]
    letters = token_counts.byte_letters()
    import json

    vocab = json.load(open(VOCAB))["model"]["vocab"]
    pieces = {tuple(token_counts.symbols(p, letters)) for p in vocab} | {(i,) for i in range(512)}
    longest = max(map(len, pieces))
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)] + [(None, "one two", None, None), (0, None, None, None)]
    got = token_counts.count_tokens(docs(rows), VOCAB).collect()
    want = sorted((i is None, i or 0, len((t or "").encode().split()), greedy(t, pieces, longest)) for i, t, _, _ in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_tokens) for r in got) == want
    assert token_counts.count_tokens(docs(rows[:1]).limit(0), VOCAB).count() == 0


# ------------------------------------------------------------------- packing
@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing_round_trip(spark, docs, capacity):
    rng = random.Random(3)
    tok = Tokenizer.from_file(VOCAB)
    tok.encode_special_tokens = True
    texts = ODD + [" ".join(words(rng, rng.randint(1, 900))) for _ in range(120)]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    got = packing.harmonic_pack(docs(rows), VOCAB, capacity=capacity, with_ids=True).collect()
    parts, bins = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert len(ids) == r.length > 0 and r.ids_crc32 == zlib.crc32(bytes(r.ids))
        parts[r.doc_id].append((r.start, ids, r.doc_tokens))
        bins[r.sequence_id].append((r.offset, r.length))
    for i, t in enumerate(texts):
        whole = tok.encode(t or "", add_special_tokens=False).ids + [2]
        at = 0
        for start, ids, n in sorted(parts[i]):
            assert (start, n) == (at, len(whole)) and ids == whole[at : at + len(ids)]
            at += len(ids)
        assert at == len(whole)
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(bins) == list(range(len(bins)))
    total = sum(r.length for r in got)
    assert len(bins) <= total / capacity * 1.02 + 1


def test_packing_ties_repeats_and_empty(spark, docs):
    same = [(5, "one two three", "en", "a")] * 6 + [(None, None, None, None)]
    got = packing.harmonic_pack(docs(same), VOCAB).collect()
    assert sum(r.length for r in got) == 6 * 4 + 1
    assert packing.harmonic_pack(docs(same).limit(0), VOCAB).count() == 0


def test_cut_covers_every_length():
    for n in range(1, 9000, 7):
        cut = packing.cut(n, 4096, 1 / 128)
        assert sum(a for a, _ in cut) == n
        assert all(0 < a <= s and a >= s * (1 - 1 / 128) for a, s in cut)


# --------------------------------------------------------------- language ID
def test_language_on_held_out_rows(spark, docs):
    rng = random.Random(4)
    alphabets = {"aa": ["ba", "bo", "bi", "ta"], "bb": ["zu", "xi", "ka", "mu"], "cc": ["schn", "acht", "ein", "ung"]}
    rows = [(i, " ".join("".join(rng.choices(alphabets[lang], k=3)) for _ in range(40)), lang, "s") for i in range(300) for lang in [rng.choice(list(alphabets))]]
    truth = {i: lang for i, _, lang, _ in rows}
    mixed = " ".join("".join(rng.choices(alphabets["aa"], k=3)) for _ in range(300)) + " " + " ".join("".join(rng.choices(alphabets["bb"], k=3)) for _ in range(200))
    rows += [(1000, mixed, None, None), (1001, None, "aa", "s"), (1002, "", "aa", "s"), (1003, "12 34 !!", "bb", "s"), (None, rows[0][1], None, None)]
    got = {r.doc_id: r for r in language_id.language_id(docs(rows)).collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 40 and all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in truth)
    assert np.mean([got[i].lang_pred == truth[i] for i in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in got.values())
    assert got[1000].languages == "aa,bb" and got[1000].lang_pred == "aa" and 0.5 < got[1000].score < 0.75
    assert [got[i].lang_pred for i in (1001, 1002, 1003)] == ["und"] * 3
    assert got[None].lang_pred == truth[rows[0][0]]


def test_language_ignores_labels_of_the_held_out_fold(spark, docs):
    rng = random.Random(6)
    base = [(i, " ".join(words(rng, 30)) if i % 2 else " ".join("zuxika" for _ in range(30)), "en" if i % 2 else "zz", "s") for i in range(60)]
    lied = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, "s") for i, t, lang, _ in base]
    one, two = ({r.doc_id: (r.lang_pred, r.score) for r in language_id.language_id(docs(x)).collect()} for x in (base, lied))
    assert one == two


def test_language_without_labels_or_rows(spark, docs):
    assert language_id.language_id(docs([(1, "text", None, None)])).first().lang_pred == "und"
    assert language_id.language_id(docs([(1, "text", "en", None)]).limit(0)).count() == 0


# ----------------------------------------------------------- near-duplicates
def shingles(text):
    w = (text or "").encode().lower().split()
    if not w:
        return set()
    return {b" ".join(w[i : i + 5]) for i in range(len(w) - 4)} or {b" ".join(w)}


def near_truth(rows):
    sets = {i: shingles(t) for i, t, *_ in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_rows(rng, copies=60):
    base = words(rng, 120)
    rows = [(i, t, "en", "a") for i, t in enumerate(ODD)]
    rows += [(100 + i, " ".join(words(rng, rng.randint(1, 200))), "en", "a") for i in range(60)]
    for i in range(copies):  # one family at all distances around the threshold
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = "edit%d" % rng.randrange(10**6)
        rows.append((300 + i, " ".join(w), "en", "a"))
    return rows + [(900 - i, rows[40][1].upper(), "en", "a") for i in range(5)]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_equal_brute_force(spark, docs, seed, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)  # several blocks in one bucket
    rows = near_rows(random.Random(seed))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs(rows)).collect()}
    want = near_truth(rows)
    assert got == want
    assert len({c for _, c in want.values()}) < len(rows)


def test_near_duplicates_nulls_repeats_empty(spark, docs):
    long = " ".join(words(random.Random(9), 30))
    got = minhash.near_duplicates(docs([(None, long, None, None), (4, long, None, None), (4, long, None, None), (2, None, None, None), (8, long + " x", None, None)])).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got) == [(0, 0, False), (2, 2, True), (4, 4, True), (4, 4, True), (8, 4, False)]
    assert minhash.near_duplicates(docs([(1, "a", None, None)]).limit(0)).count() == 0


def test_estimate_is_close():
    rng = np.random.default_rng(1)
    for share in (0.2, 0.6, 0.9):
        got = []
        for _ in range(40):
            x = rng.integers(0, 2**63, 1000).astype(np.uint64)
            y = np.r_[x[: int(1000 * 2 * share / (1 + share))], rng.integers(0, 2**63, 1000 - int(1000 * 2 * share / (1 + share))).astype(np.uint64)]
            equal = (minhash.registers(x) == minhash.registers(y)).sum()
            got.append(float(minhash.estimate(np.array(equal), np.array(1000.0), np.array(1000.0))))
        assert abs(np.mean(got) - share) < 0.03


# ------------------------------------------------------------------- repeats
def repeats_truth(rows, width=50):
    out = {}
    first = {}
    texts = sorted(((i, (t or "").encode()) for i, t, *_ in rows if i is not None))
    for i, t in texts:
        for p in range(len(t) - width + 1):
            first.setdefault(t[p : p + width], i)
    for i, t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - width + 1):
            if first[t[p : p + width]] < i:
                gone[p : p + width] = b"\1" * width
        spans = sum(1 for p in range(len(t)) if gone[p] and (p == 0 or not gone[p - 1]))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out[i] = (len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("chunk_bytes,names", [(2_000, 500), (1 << 22, 10**6)])
def test_repeats_equal_brute_force(spark, docs, chunk_bytes, names, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUCKET_NAMES", names)
    rng = random.Random(8)
    passages = [" ".join(words(rng, n)) for n in (5, 9, 20, 60)] + ["é" * 40, "z" * 200]
    rows = [(i, t, "en", "a") for i, t in enumerate(ODD)]
    for i in range(80):
        parts = [" ".join(words(rng, rng.randint(0, 30)))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randrange(0, len(p) // 2)
            parts += [p[a : a + rng.randint(20, len(p))], " ".join(words(rng, rng.randint(0, 12)))]
        rows.append((1000 - 3 * i, "".join(parts), "en", "a"))
    rows += [(2000 + i, rows[20][1], "en", "a") for i in range(4)] + [(3000, "z" * 49, "en", "a"), (3001, "z" * 49, "en", "a")]
    got = suffix_dedup.remove_repeats(docs(rows), chunk_bytes=chunk_bytes, keep=["score"], with_text=True).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == repeats_truth(rows)
    assert all(r.score == 0.5 for r in got)
    texts = {i: t for i, t, *_ in rows}
    assert all(r.kept_text == (texts[r.doc_id] or "") for r in got if not r.n_removed)


def test_repeats_of_one_id_nulls_and_empty(spark, docs):
    t = " ".join(words(random.Random(3), 40))
    got = suffix_dedup.remove_repeats(docs([(1, t, None, None), (1, t, None, None), (None, t, None, None), (2, t, None, None)])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (1, 0), (1, 0), (2, len(t))]
    assert suffix_dedup.remove_repeats(docs([(1, t, None, None)]).limit(0)).count() == 0


def test_cover_holds_every_shift_and_names_round_trip():
    for i in range(21):
        for j in range(21):
            assert any((i + d) % 21 in suffix_dedup.COVER and (j + d) % 21 in suffix_dedup.COVER for d in range(21))
    rng = np.random.default_rng(2)
    for size, top in ((0, 10), (1, 2**63), (5000, 2**40), (300, 400)):
        x = np.unique(rng.integers(0, top, size).astype(np.uint64))
        assert (suffix_dedup.unpacked(suffix_dedup.packed(x)) == x).all()
    buf = rng.integers(97, 99, 400).astype(np.uint8)
    names = suffix_dedup.Names(buf)
    for width in (1, 30, 38, 50):
        name = names.at(np.arange(400 - width + 1), width)
        seen = {}
        for p, v in enumerate(name.tolist()):
            assert seen.setdefault(buf[p : p + width].tobytes(), v) == v
        assert len(set(name.tolist())) == len(seen)


def test_shingle_sets_match_words():
    texts = [None if t is None else t.encode() for t in ODD]
    assert [len(s) for s in kernels.shingle_sets(texts)] == [len(shingles(t)) for t in ODD]
