"""Flat word encoding, best-fit packing, phrase collocations and hard negatives against brute force."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from parcelflow.llm import bestfit, collocations, flat_words, hard_negatives

WORD = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, number string, length string, task string, times string"
ODD = ["", " ", "\n", "a", "a  b", "  x\n\n y  ", "<|endoftext|>", "a<|endoftext|> b", "ΑΣ ΣΑΣ İ K", "a\x1cb", "日本 語",
       "don't I'LL 'tis x''s it's 'save 'l 're're 12 3½", "aaaaaaaaaaaa aaa", "\x85a\xa0b", "😀😀 x", "word " * 3000,
       "tab\tand\r\nreturn", "naïve Ünï ÉÀ œŒ ŉ ſ", "x" * 70 + " y", "‘quoted’ “x” – — …", "ª º µ ×÷ 3²", "1234 a1b2"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(WORD)
    out.no_truncation()
    out.no_padding()
    return lambda text: out.encode(text, add_special_tokens=False).ids


def cases() -> list[str]:
    rnd = random.Random(2)
    letters = "ab '\n\t st1.éÜ  ñ<|>ΣA—"
    return ODD + ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(500)]


def test_flat_words_equal_the_library(library, monkeypatch):
    own = flat_words.FlatWords(WORD)
    want = [library(t) for t in cases()]
    for _ in range(2):  # the second time from memory
        assert [x.tolist() for x in own.encode_batch(cases())] == want
    monkeypatch.setattr(flat_words, "STORE_WORDS", 50)
    monkeypatch.setattr(flat_words, "SLICE_CHARS", 300)  # a text of many slices, and a memory that starts anew
    assert [x.tolist() for x in own.encode_batch(cases())] == want


def test_flat_words_with_doubtful_hashes(library, monkeypatch):
    """Words that share a first hash go through the plain encoder."""
    own = flat_words.FlatWords(WORD)
    hashes = own._hashes

    def coarse(cps, starts, ends):
        key, check = hashes(cps, starts, ends)
        return [key % np.uint64(7), check]

    monkeypatch.setattr(own, "_hashes", coarse)
    texts = ["one two three", "four five six seven", "eight nine ten"] * 3
    assert [x.tolist() for x in own.encode_batch(texts)] == [library(t) for t in texts]


def doc_rows() -> list[tuple]:
    texts = [*ODD, None, "hot text of one length"] + ["hot text of one length"] * 30
    out = [(i, t, None, None if i % 9 == 0 else f"s{i % 4}", "clash", "clash", "clash", "clash") for i, t in enumerate(texts)]
    return out + [(None, "no id", "en", "s1", "", "", "", ""), (3, texts[3], None, None, None, None, None, None)]


@pytest.mark.parametrize("window", [2048, 16])
def test_bestfit_packing(spark, library, window):
    docs = spark.createDataFrame(doc_rows(), SCHEMA).repartition(3)
    got = bestfit.pack(docs, WORD, window, keep_ids=True).toPandas()
    assert bestfit.pack(docs.limit(0), WORD, window).count() == 0
    want = Counter()
    for row in doc_rows():
        ids = np.array([*library(row[1] or ""), 0], "<u4")
        for no, start in enumerate(range(0, len(ids), window)):
            part = ids[start:start + window].tobytes()
            want[(row[0], no, start, len(part) // 4, zlib.crc32(part), part)] += 1
    ids = [None if x != x else int(x) for x in got["doc_id"]]
    assert Counter(zip(ids, got["piece"], got["start"], got["length"], got["ids_crc32"], map(bytes, got["ids"]))) == want
    for _, part in got.sort_values("offset").groupby("sequence_id"):
        assert part["length"].sum() <= window
        assert part["offset"].tolist() == (part["length"].cumsum() - part["length"]).tolist()
    assert got["sequence_id"].nunique() <= first_fit(got["length"].tolist(), window)


def first_fit(sizes: list[int], window: int) -> int:
    """Sequences that longest-first, first-fit packing takes."""
    free: list[int] = []
    for x in sorted(sizes, reverse=True):
        at = next((j for j, f in enumerate(free) if f >= x), None)
        if at is None:
            free.append(window - x)
        else:
            free[at] -= x
    return len(free)


def fewest(sizes: tuple[int, ...], window: int) -> int:
    """The least number of sequences, by trying all assignments."""
    best = len(sizes)

    def place(i: int, free: list[int]) -> None:
        nonlocal best
        if len(free) >= best:
            return
        if i == len(sizes):
            best = len(free)
            return
        for j in {f: j for j, f in enumerate(free) if f >= sizes[i]}.values():
            place(i + 1, [*free[:j], free[j] - sizes[i], *free[j + 1:]])
        place(i + 1, [*free, window - sizes[i]])

    place(0, [])
    return best


def test_bestfit_plan_is_close_to_the_least():
    rnd, over = random.Random(8), 0
    for _ in range(300):
        sizes = tuple(sorted((rnd.randint(1, 20) for _ in range(rnd.randint(0, 9))), reverse=True))
        patterns = bestfit.plan(np.bincount(sizes, minlength=21), 20)
        used = Counter(x for lengths, times in patterns for x in lengths for _ in range(times))
        assert used == Counter(sizes) and all(sum(lengths) <= 20 for lengths, _ in patterns)
        over += sum(times for _, times in patterns) - fewest(sizes, 20)
    assert over <= 3
    rng = np.random.default_rng(1)
    for sizes in (rng.integers(1, 2049, 50_000), np.full(50_000, 700), rng.integers(1, 300, 9_000)):
        patterns = bestfit.plan(np.bincount(sizes, minlength=2049), 2048)
        least = max(-(-sizes.sum() // 2048), (sizes > 1024).sum(), -(-len(sizes) // 2) if sizes.min() > 682 else 0)
        assert sum(times for _, times in patterns) <= 1.005 * least


def test_sum_index_finds_the_closest_sum():
    rnd = random.Random(3)
    for _ in range(200):
        left = np.array([0] + [rnd.choice([0, 0, 1, 2]) for _ in range(14)])
        pool = [x for x in range(15) for _ in range(left[x])]
        for gap in range(1, 15):
            sums = {sum(c) for n in (1, 2, 3) for c in itertools.combinations(pool, n) if sum(c) <= gap}
            found = bestfit.SumIndex(left, 14).best(gap)
            assert sum(found) == max(sums, default=0) and not Counter(found) - Counter(pool)


def phrase_rows() -> list[tuple]:
    rnd = random.Random(6)
    words = [f"w{i}" for i in range(5)] + ["Ünï", "A-B", "x\xa0y", "İ"]
    rows = []
    for i in range(260):
        text = "".join(rnd.choice(words) + rnd.choice([" "] * 12 + [". ", "\n", "\t", ", ", "; ", "  ", "! x.y\r\n"])
                       for _ in range(rnd.randint(0, 60)))
        rows.append((i, text, rnd.choice(["en", "en", "de", None, "und", ""]), None, "c", "c", "c", "c"))
    passage = "the quick Brown fox jumps over the lazy dog and runs far away from here"
    rows += [(300 + i, f"{passage} {'z ' * (i % 3)}" if i % 2 else passage, "en", "s", "c", "c", "c", "c") for i in range(150)]
    rows += [(1, rows[1][1], rows[1][2], None, None, None, None, None)] * 3
    return rows + [(900, None, None, None, None, None, None, None), (None, "", "en", None, None, None, None, None),
                   (901, "hot " * 30_000, "de", None, None, None, None, None), (902, " .;", "fr", None, None, None, None, None)]


def brute_phrases(rows, max_words: int, min_count: int, keep_percent: int = 100) -> set:
    counts, totals = defaultdict(Counter), Counter()
    for r in rows:
        lang = r[2] if r[2] is not None else "und"
        text = re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for k in range(1, max_words + 1):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = set()
    for lang, f in counts.items():
        rows_ = []
        often = [p for p, a in f.items() if len(p) > 1 and a >= min_count]
        for p in often:
            a = f[p]
            if any(100 * f[q] >= keep_percent * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q in often if len(q) > len(p)):
                continue
            score, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows_.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows_), 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return out


@pytest.mark.parametrize("options", [{}, {"modulus": 3}, {"modulus": 1, "table_bits": 6}, {"max_words": 3, "keep_percent": 60},
                                     {"max_words": 2, "modulus": 2}])
def test_collocations(spark, options):
    docs = spark.createDataFrame(phrase_rows(), SCHEMA).repartition(4)
    got = collocations.mine(docs, min_count=12, top=None, **options).collect()
    want = brute_phrases(phrase_rows(), options.get("max_words", 5), 12, options.get("keep_percent", 100))
    assert len(want) > 50 or options.get("max_words")
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_collocations_top_and_empty(spark):
    docs = spark.createDataFrame(phrase_rows(), SCHEMA)
    got = {tuple(r) for r in collocations.mine(docs, min_count=12, top=4).collect()}
    assert got == {r for r in brute_phrases(phrase_rows(), 5, 12) if r[1] <= 4}
    assert collocations.mine(docs.limit(0)).count() == 0 and collocations.mine(docs.where("text is null")).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    big = 10**16
    frequent = spark.createDataFrame([("en", 1, "a", big + 3), ("en", 1, "b", big + 7), ("en", 2, "a b", big + 1)],
                                     "lang string, k int, phrase string, n long")
    totals = spark.createDataFrame([("en", 9 * big + 11)], "lang string, n long")
    got = collocations.scored(frequent, totals).first()
    assert got["score"] == 1000 * (big + 1) * (9 * big + 11) // ((big + 3) * (big + 7))


def test_parse_counts_every_ngram_once():
    rnd = random.Random(1)
    texts = [" ".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 50))).encode() for _ in range(40)]
    for modulus in (1, 2, 5, 1000):
        owner, own, chunks = collocations.parse(texts, 4, modulus)
        for k in (1, 3, 5):
            got, want = Counter(), Counter()
            for n, c in zip(own, chunks):
                words = c.split()
                got.update(tuple(words[i:i + k]) for i in range(n) if i + k <= len(words))
            for t in texts:
                words = t.split()
                want.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
            assert got == want


VECTORS = "vec_id long, label int, embedding array<float>, pack string, score string, tile string"


def vector_rows(kind: str) -> list[tuple]:
    rng = np.random.default_rng(9)
    if kind == "noise":
        x = rng.normal(size=(700, 12))
    else:
        x = rng.normal(size=(8, 12))[rng.integers(0, 8, 700)] + 0.3 * rng.normal(size=(700, 12))
        x = x * rng.uniform(0.2, 3, (700, 1))
    x = x.astype(np.float32)
    x[300:520] = x[100]  # one vector has almost a third of all rows
    x[640:650] = 0
    label = rng.integers(0, 4, 700)
    label[660:] = -1
    rows = [(i, int(y), [float(c) for c in v]) for i, (y, v) in enumerate(zip(label, x))]
    rows += rows[50:60]  # repeated rows
    rows += [(1000, None, rows[0][2]), (1100, 1, None), (1200, 1, [float("nan")] * 12), (1300, 2, [float("inf")] + [1.0] * 11),
             (1400, 1, []), (1500, 1, [None] + [1.0] * 11), (1600, 3, [1.0, 2.0]), (None, 1, rows[0][2]),
             (100, 2, rows[5][2]), (7, 3, rows[9][2])]  # ids with two different rows
    return [(*r, "x", "x", "x") for r in rows]


def brute_negatives(rows, modulus: int) -> list[tuple]:
    once = sorted({(i, y, tuple(v)) for i, y, v, *_ in rows
                   if i is not None and y is not None and v and len(v) == 12 and None not in v and np.isfinite(v).all()})
    whole = np.floor(np.array([r[2] for r in once]) * 256).astype(np.int64)
    out = []
    for n, (i, y, _) in enumerate(once):
        if i % modulus:
            continue
        score = (whole @ whole[n]).tolist()
        order = sorted((j for j in range(len(once)) if once[j][0] != i), key=lambda j: (-score[j], once[j][0]))
        for p in [j for j in order if once[j][1] == y][:5]:
            fit = [j for j in order if once[j][1] != y and 30 * score[p] <= 100 * score[j] <= 90 * score[p]]
            out += [(i, once[p][0], rank, once[j][0], score[p], score[j]) for rank, j in enumerate(fit[:10], 1)]
    return sorted(out)


@pytest.mark.parametrize("kind", ["noise", "clusters"])
@pytest.mark.parametrize("sizes", [{}, {"stripe_rows": 50, "tile_rows": 3, "reference_count": 4}])
def test_hard_negatives(spark, kind, sizes):
    rows = vector_rows(kind)
    frame = spark.createDataFrame(rows, VECTORS).repartition(5)
    got = hard_negatives.mine(frame, "vec_id % 20 = 0", **sizes).collect()
    want = brute_negatives(rows, 20)
    assert len(want) > 200 and sorted(map(tuple, got)) == want


def test_hard_negatives_without_rows(spark):
    frame = spark.createDataFrame(vector_rows("noise"), VECTORS)
    assert hard_negatives.mine(frame.limit(0), "vec_id % 20 = 0").count() == 0
    assert hard_negatives.mine(frame, "vec_id < 0").count() == 0
    zero = frame.where("vec_id between 640 and 649")
    assert hard_negatives.mine(zero, "vec_id % 2 = 0").toPandas()["positive_score"].sum() == 0


def test_score_bounds_hold_and_products_are_exact():
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(size=(400, 6)) * 256)
    x[200:] = np.round(x[:200] * 1.0)  # same directions: angles of zero
    refs = rng.normal(size=(5, 6))
    refs /= np.linalg.norm(refs, axis=1)[:, None]
    norms = hard_negatives._norms(x)
    cos = hard_negatives._cosines(x, norms, refs)
    ids = np.arange(400).tobytes()
    pack = hard_negatives.Pack(ids, ids, x.tobytes(), norms.tobytes(), cos.tobytes())
    low, high = hard_negatives.score_bounds(pack, slice(0, 400), pack)
    assert (low <= x @ x.T).all() and (x @ x.T <= high).all()
    for size in (1, 1 << 18, 1 << 24):
        a, b = np.floor(x[:50] * size), np.floor(x[3] * size)
        bound = float(hard_negatives._norms(a).max() * np.sqrt(b @ b))
        want = [sum(int(p) * int(q) for p, q in zip(r, b)) for r in a]
        assert hard_negatives.products(a, b, bound).tolist() == want
