"""N-gram join, spelling variants and source divergence against brute force, on awkward tables."""

from __future__ import annotations

import random
import re
import time
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from acceptance.compare import connect, difference
from tillwatch.llm import divergence, ngram_join, spelling
from tillwatch.llm.queries import ORACLE, QUERIES
from tillwatch.llm.text import BATCH_BYTES, CHUNK_BYTES, CLEAN_UP, written

SCHEMA = "doc_id long, text string, lang string, source string, n long, gram string, term string, word string, node long"
SF_DIR = "/root/testdata/sf0.001"


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def frame(spark, rows, parts=3):
    """(doc_id, text, lang, source) with further columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, 7, "clash", "clash", "clash", 3) for r in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_registered_query_matches_its_sql(spark, name):
    assert difference(spark, connect(SF_DIR), SF_DIR, QUERIES[name], ORACLE[name]) is None


# ---- n-gram join ----------------------------------------------------------------------------


def near_texts(rng: random.Random) -> list[str | None]:
    """Families with a word or two changed, copies of copies, one common line, and odd texts."""
    vocabulary = [f"w{i}" for i in range(400)]
    line = " ".join(rng.choices(vocabulary, k=24))
    texts: list[str | None] = [None, "", " \t\n", "one", "One", "one two three", "one two three", "one two three four"]
    for _ in range(6):
        base = rng.choices(vocabulary, k=rng.choice([15, 30, 80, 200]))
        family = [base]
        for _ in range(12):
            words = list(rng.choice(family))
            for _ in range(rng.choice([1, 1, 2, 3])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                words = words[: -rng.randrange(1, 4)]
            family.append(words)
        texts += [" ".join(w) for w in family]
    for _ in range(60):  # short texts around one line, of which only some are similar enough
        texts.append(" ".join(rng.choices(vocabulary, k=rng.randrange(0, 9))) + " " + line)
    texts += [line.upper(), line, line + " x", " ".join(rng.choices(vocabulary, k=6000))]
    return texts


def grams(text: str | None, k: int = 5) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def linked_classes(rows, percent):
    sets = [grams(text) for _, text in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * len(sets[i] | sets[j]):
                parent[top(i)] = top(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[top(i)].append(doc_id)
    ids = {root: min((d for d in found if d is not None), default=None) for root, found in least.items()}
    return Counter((doc_id, len(sets[i]), ids[top(i)]) for i, (doc_id, _) in enumerate(rows))


@pytest.mark.parametrize("shape", [
    ngram_join.NgramJoin(),
    # Few bits, low limits: wrong hits, hot n-grams that stay ordinary, many rows a bucket.
    ngram_join.NgramJoin(rare=2, hot_limit=50, bits=10, block=4, fragments=3, percent=70),
], ids=["usual", "crowded"])
def test_ngram_join_finds_the_classes_of_all_pairs(spark, shape):
    texts = near_texts(random.Random(shape.block))
    rows = [(100 + i, t) for i, t in enumerate(texts)]
    rows += [(None, texts[10]), (3, texts[10]), (3, texts[10]), (None, None)]
    docs = frame(spark, [(i, t, None, "s") for i, t in rows])
    got = Counter(tuple(r) for r in ngram_join.ngram_links(docs, shape).collect())
    assert got == linked_classes(rows, shape.percent)


def test_ngram_join_of_nothing(spark):
    assert ngram_join.ngram_links(frame(spark, [(1, "a", "b", "c")]).limit(0)).collect() == []
    alone = ngram_join.ngram_links(frame(spark, [(1, None, "b", "c"), (2, "", "b", "c")])).collect()
    assert sorted(map(tuple, alone)) == [(1, 0, 1), (2, 0, 2)]


# ---- spelling variants ----------------------------------------------------------------------


def counted_words(rows, shape):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % shape.noise == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= shape.least_points and n >= shape.least_count}


def edits(word, letters):
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    out |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    out |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters}
    return out - {word}


def spelled(words):
    letters = {c for w in words for c in w}
    near = {w: edits(w, letters) & words.keys() for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    rows = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return rows


@pytest.mark.parametrize("shape", [spelling.Variants(), spelling.Variants(noise=3, block=7, groups=5, top=2)], ids=["usual", "crowded"])
def test_spelling_forms_are_those_of_all_edits(spark, shape):
    rng = random.Random(3)
    stems = ["banana", "bandana", "straße", "Über", "Élan×", "colour", "color", "aaaaaaa", "abcdefgh", "x" * 3000]
    words = [*stems, *["".join(rng.choices("abcé", k=rng.randrange(4, 8))) for _ in range(60)]]
    words += [w for stem in stems[:9] for w in sorted(edits(stem, "ax"))[::7]]
    rows = [(i, " ".join(rng.choices(words, k=150)) + "7" + rng.choice(words).upper()) for i in range(60)]
    rows += [(None, "colour colour, colour"), (None, None), (1, ""), (2, "  "), (3, rows[3][1]), (3, rows[3][1])]
    got = spelling.spelling_forms(frame(spark, [(i, t, "l", None) for i, t in rows]), shape).collect()
    want = spelled(counted_words(rows, shape))
    assert len(got) == len(want) > 40
    assert {tuple(r) for r in got} == want


def test_spelling_forms_of_nothing(spark):
    docs = frame(spark, [(1, None, None, None), (2, "a bb ccc", None, None)])
    assert spelling.spelling_forms(docs).collect() == []
    assert spelling.spelling_forms(docs.limit(0)).collect() == []


def test_roots_follow_long_chains(spark):
    forms = [(f"w{i}", f"w{i + 1}" if i < 37 else None) for i in range(38)]
    df = spark.createDataFrame(forms, "word string, form string")
    assert {r.root for r in spelling._roots(df).collect()} == {"w37"}


# ---- source divergence ----------------------------------------------------------------------


def audited(rows, audit):
    """In whole numbers of Python, term by term."""
    held = defaultdict(Counter)
    counts = defaultdict(Counter)
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text))
        counts[lang or "", source or ""].update(terms)
        held[lang or ""].update(set(terms))
    out = set()
    for lang in {g[0] for g in counts}:
        kept = sorted(t for t, n in held[lang].items() if n >= audit.least_docs)
        whole = Counter()
        for group, c in counts.items():
            if group[0] == lang:
                whole.update(c)

        def share(c, t, kept=kept):
            return 1 + audit.unit * (c[t] + audit.prior) // (sum(c[k] for k in kept) + audit.prior * len(kept))

        def cost(p, q):
            return (p - q) ** 2 // (p + q)

        sources = sorted(s for la, s in counts if la == lang)
        p = {s: {t: share(counts[lang, s], t) for t in kept} for s in sources}
        q = {t: share(whole, t) for t in kept}
        for s in sources:
            pairs = [(-sum(cost(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            tops = [(-cost(p[s][t], q[t]), t) for t in kept if counts[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(tops)[: audit.top])):
                out |= {(lang, s, part, item, -value, i + 1) for i, (value, item) in enumerate(found)}
    return out


@pytest.mark.parametrize("audit", [divergence.Audit(), divergence.Audit(least_docs=2, segment=8, block=2, top=3, chunk_bytes=100)], ids=["usual", "cut"])
def test_divergence_is_exact(spark, audit):
    rng = random.Random(5)
    words = ["Alpha", "beta", "GAMMA", "délta", "Ünder", "eps2zeta", "don't", *[f"t{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(9)]]
    rows = []
    for i in range(150):
        k = rng.choice([0, 1, 20, 60])
        some = words[:: rng.choice([1, 2, 3])]
        rows.append((" ".join(rng.choices(some, k=k)), rng.choice(["en", "de", None, ""]), f"s{i % 7}" if i % 5 else None))
    rows += [(None, "en", "silent"), ("", "only", "a"), ("rare words here", "only", "b"), (rows[0][0], "en", "s1"), (rows[0][0], "en", "s1")]
    rows.append((" ".join(rng.choices(words, k=30_000)), "en", "long"))
    docs = frame(spark, [(i, *r) for i, r in enumerate(rows)])
    got = divergence.divergence(docs, audit).collect()
    want = audited(rows, audit)
    assert len(got) == len(want)
    assert {tuple(r) for r in got} == want
    assert divergence.divergence(docs.limit(0), audit).collect() == []


def test_trees_share_nodes_and_price_like_a_plain_sum():
    counts = np.zeros((3, 1000), np.int64)
    counts[0, :40] = np.arange(40) * 7
    counts[1, :40] = counts[0, :40]
    counts[1, 500] = 3
    forest = divergence.Forest(counts)
    assert sum(map(len, forest.children)) < 120  # 3 x 1,023 without sharing
    audit = divergence.Audit()
    n = counts.sum(1).tolist()
    for i in range(3):
        for j in range(3):
            p, q = (divergence.shares(forest.leaves, n[k], 1000, audit) for k in (i, j))
            a, b = (divergence.shares(counts[k], n[k], 1000, audit) for k in (i, j))
            assert forest.price(i, j, p, q) == int(((a - b) ** 2 // (a + b)).sum())


def test_shares_stay_exact_for_counts_beyond_long_products():
    counts, n, v = np.asarray([-1, 0, 5 * 10**12]), 9 * 10**12, 4
    assert divergence.shares(counts, n, v).tolist() == [0, 1 + 2 * 10**9 // (n + 8), 1 + 10**9 * (5 * 10**12 + 2) // (n + 8)]


def test_share_in_sql_is_the_same(spark):
    df = spark.createDataFrame([(5 * 10**12, 9 * 10**12, 4)], "c long, n long, v long")
    got = df.select(divergence._share(F.col("c"), F.col("n"), F.col("v"), divergence.Audit())).first()[0]
    assert got == 1 + 10**9 * (5 * 10**12 + 2) // (9 * 10**12 + 8)


def test_shuffle_files_go_as_soon_as_a_frame_is_stored(spark):
    """op11_ngram_join: shuffle files of all steps stayed until the driver collected garbage."""
    folders = [Path(d.getPath()) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def shuffled():
        return {f for d in folders for f in d.rglob("shuffle_*")}

    before, kept = shuffled(), spark.conf.get(CLEAN_UP)
    frame = spark.range(100_000).groupBy((F.col("id") % 1009).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    stored = written(frame, "counts")
    end = time.monotonic() + 20
    while time.monotonic() < end and shuffled() - before:
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get(CLEAN_UP) == kept and stored.count() == 1009


def test_texts_reach_python_by_a_few_megabytes(spark):
    """pipeline, exact_dedup: a batch held ten thousand rows of whatever length, several times over in a task."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])

    kept = spark.conf.get(BATCH_BYTES)
    long = spark.range(0, 600, 1, 1).select(F.repeat(F.lit("abcdefghij"), 5_000).alias("text"))
    stored = written(long.mapInArrow(sizes, "n long, size long"), "sizes")
    most, rows = stored.agg(F.max("size"), F.sum("n")).first()
    assert most < 3 * CHUNK_BYTES and rows == 600
    assert spark.conf.get(BATCH_BYTES) == kept
