"""Cases in which an operator or a stage did less than its whole job."""

import corpus_pipeline
from conftest_llm import edit, prose, unordered
from rentscope.llm import near_dedup, substring_dedup
from test_duplicates import substring_expected


def near_groups(texts, size):
    """For every text the least number of a text it is linked with, over some links, by brute force."""
    sets = []
    for text in texts:
        words = text.lower().split()
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)})
    labels = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 100 * len(a & b) >= 80 * len(a | b):
                low, high = sorted((labels[i], labels[j]))
                labels = [low if x == high else x for x in labels]
    return labels


def test_pipeline_near_stage_takes_five_words(spark):
    """Three edits in 120 words: 0.81 on four words, 0.77 on five."""
    texts = []
    for seed in range(6):
        base = " ".join(prose(seed + 50, 120).split())
        texts += [base, edit(base, 20, 60, 100), edit(base, 40)]
    texts.append(edit(texts[1], 5, 80))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    five = [i for i, label in enumerate(near_groups(texts, 5)) if i == label]
    assert five != [i for i, label in enumerate(near_groups(texts, 4)) if i == label]
    found = corpus_pipeline.near(spark, frame, "")
    assert sorted(r.doc_id for r in found.collect()) == five
    assert sorted(r.doc_id for r in near_dedup.keep_one(frame).collect()) == five


def test_near_keep_one_of_null_and_repeated_ids(spark):
    """One row of each group stays, though its ids are null or its least id stands on two texts."""
    null, twice, mixed = (" ".join(prose(seed, 150).split()) for seed in (70, 71, 72))
    rows = [(None, null), (None, edit(null, 9)), (None, edit(null, 90)), (None, ""), (None, " ")]
    rows += [(7, twice), (7, edit(twice, 9)), (8, edit(twice, 90)), (None, mixed), (9, edit(mixed, 9)), (9, null[::-1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = [(r.doc_id, r.text) for r in near_dedup.keep_one(frame).collect()]
    assert len([r for r in found if r in rows[:3]]) == 1
    assert len([r for r in found if r in rows[5:8]]) == 1
    assert unordered(r for r in found if r not in rows[:3] + rows[5:8]) == unordered(rows[3:5] + rows[9:])
    marked = [r.kept for r in near_dedup.mark(frame).collect() if r.component_id == 7]
    assert sorted(marked) == [False, True, True]


def test_substring_extents_of_more_windows_than_a_mask_has_bits(spark):
    """Copies of 163 words have 64 windows of 100 words, in many of them around one anchor."""
    texts = [" ".join(prose(seed + 400, 163).split()[:163]) for seed in range(24)] * 2
    passage = " ".join(prose(500, 180).split())
    texts += [f"{prose(seed + 510, 90)} {passage} {prose(seed + 520, 90)}" for seed in range(3)] + [prose(530, 400)]
    rows = [(i, text, None) for i, text in enumerate(texts)]
    frame = spark.createDataFrame([(i, text) for i, text, _ in rows], "doc_id long, text string")
    assert unordered(substring_dedup.clean(frame, 100, 8).collect()) == substring_expected(rows, 100)
