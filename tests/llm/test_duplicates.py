import hashlib
import random

import numpy as np
import pytest
from conftest_llm import prose
from conftest_llm import unordered
from rentscope.llm import components, exact_dedup, near_dedup, substring_dedup

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def exact_expected(rows):
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        same = [i for i, t, _ in rows if (t or "") == text]
        keep = max((i for i in same if i is not None), default=None)
        out.append((doc_id, keep, len(same), doc_id == keep, hashlib.sha256(text.encode()).hexdigest()))
    return out


def one_kept(found):
    by_text = {}
    for r in found:
        by_text.setdefault(r.text_sha256, []).append(r.kept)
    return all(sum(x) == 1 for x in by_text.values())


@pytest.mark.parametrize("options", [{}, {"files_per_batch": 1}, {"digest_chars": 1}])
def test_exact(docs, rows, options):
    found = exact_dedup.mark(docs, **options).collect()
    # Row 3 repeats whole; one of the two stays, so compare without the flag, then the flag.
    plain = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found]
    assert unordered(plain) == unordered((a, b, c, e) for a, b, c, _, e in exact_expected(rows))
    assert one_kept(found)
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_exact_keep_one(docs, rows):
    found = exact_dedup.keep_one(docs)
    assert found.columns == docs.columns
    assert unordered(r.text or "" for r in found.collect()) == unordered({t or "" for _, t, _ in rows})


def test_exact_state_goes_on_over_batches(spark, tmp_path):
    frame = spark.createDataFrame([(i, f"text {i % 5}") for i in range(200)], "doc_id long, text string")
    found = exact_dedup.mark(frame.repartition(8), files_per_batch=1).collect()
    assert sorted(r.doc_id for r in found if r.kept) == [195, 196, 197, 198, 199]
    assert {r.group_size for r in found} == {40}


def test_exact_empty(no_docs):
    assert exact_dedup.mark(no_docs).count() == 0
    assert exact_dedup.keep_one(no_docs).count() == 0


def shingles(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    if len(words) < 4:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 4]) for i in range(len(words) - 3)}


def near_expected(rows):
    sets = [shingles(t) for _, t, _ in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                parent[root(i)] = root(j)
    out = []
    for i, (doc_id, _, _) in enumerate(rows):
        mine = [rows[j][0] for j in range(len(rows)) if root(j) == root(i)]
        least = min((d for d in mine if d is not None), default=None)
        if not sets[i]:
            least = doc_id
        out.append((doc_id, len(sets[i]), least, doc_id == least))
    return unordered(out)


def test_near(docs, rows):
    assert unordered(near_dedup.mark(docs).collect()) == near_expected(rows)


def test_near_chains_and_groups(spark):
    """Texts that drift word by word: neighbours are linked, ends are not; and many near copies."""
    base = prose(1, 120).split()
    rows, words = [], list(base)
    for i in range(40):
        rows.append((1000 - i, " ".join(words), None))
        words[(3 * i) % len(words)] = f"drift{i}"
    other = prose(2, 100).split()
    for i in range(60):
        copy = list(other)
        for place in random.Random(i).sample(range(100), 3):
            copy[place] = f"w{i}{place}"
        rows.append((i, " ".join(copy), None))
    random.Random(5).shuffle(rows)
    frame = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    assert unordered(near_dedup.mark(frame).collect()) == near_expected(rows)


def test_near_keep_one(docs, rows):
    kept = unordered((r[0],) for r in near_expected(rows) if r[3])
    assert unordered(near_dedup.keep_one(docs).select("doc_id").collect()) == kept


def test_near_empty(no_docs):
    assert near_dedup.mark(no_docs).count() == 0


@pytest.mark.parametrize("size", [1, 2, 7, 60, 2000])
def test_sketch_fills_and_estimates(size):
    rng = np.random.default_rng(size)
    a = rng.integers(0, 2**63, size).astype(np.uint64)
    b = np.concatenate([a[: size // 2], rng.integers(0, 2**63, size - size // 2).astype(np.uint64)])
    one, two = near_dedup.sketch(np.sort(a)), near_dedup.sketch(np.sort(b))
    assert (one < np.iinfo(np.uint64).max).all()
    assert (near_dedup.sketch(np.sort(a)[::-1]) == one).all()
    truth = len(set(a) & set(b)) / len(set(a) | set(b))
    assert abs((one == two).mean() - truth) < 0.15


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 50), (50, 70), (200, 201), (5, 5)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.label for r in components.components(frame).collect()}
    assert {found[i] for i in range(31)} == {0}
    assert [found[i] for i in (50, 70, 100, 200, 201)] == [50, 50, 50, 200, 200]


def substring_expected(rows, window):
    texts = [WORD.findall(t or "") for _, t, _ in rows]
    where = {}
    for i, words in enumerate(texts):
        for s in range(len(words) - window + 1):
            where.setdefault(tuple(words[s : s + window]), []).append((i, s))
    gone = [set() for _ in rows]
    for places in where.values():
        if len(places) > 1:
            for i, s in places:
                gone[i].update(range(s, s + window))
    out = []
    for (doc_id, _, _), words, removed in zip(rows, texts, gone, strict=True):
        kept = " ".join(w for k, w in enumerate(words) if k not in removed)
        out.append((doc_id, len(words), len(removed), kept))
    return unordered(out)


@pytest.mark.parametrize("window, seed", [(35, 8), (12, 3), (9, 9)])
def test_substring(docs, rows, window, seed):
    assert unordered(substring_dedup.clean(docs, window, seed).collect()) == substring_expected(rows, window)


def test_substring_digests_and_strip(docs, rows):
    wanted = substring_expected(rows, 35)
    sums = unordered((a, b, c, hashlib.sha256(d.encode()).hexdigest()) for a, b, c, d in wanted)
    assert unordered(substring_dedup.digests(docs).collect()) == sums
    found = substring_dedup.strip(docs)
    assert found.schema.simpleString() == docs.schema.simpleString()
    texts = unordered((r.doc_id, len(WORD.findall(r.text or ""))) for r in found.collect())
    assert texts == unordered((a, b - c) for a, b, c, _ in wanted)
    changed = [r for r in found.collect() if r.n_chars != len(r.text or "")]
    assert not changed


def test_substring_empty(no_docs):
    assert substring_dedup.digests(no_docs).count() == 0
    assert substring_dedup.strip(no_docs).count() == 0
