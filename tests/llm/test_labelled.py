"""Which texts teach the classifiers."""

from casemart.llm.labelled import held_out, labelled_sample
from casemart.llm.substring_dedup import remove_repeats


def test_one_text_for_each_id_and_no_contradictions(spark):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(40)] + [(3, "another 3")] * 50 + [(None, "x"), (8, None)], "doc_id long, text string").repartition(5)
    labels = [(k, k % 2) for k in range(40)] + [(3, 1)] * 5 + [(4, 1), (None, 1), (6, None), (99, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    learned = {r.id for r in spark.range(40).where(~held_out("id")).collect()}
    sample, counts = labelled_sample(docs, labels, "quality", {0: 100, 1: 100})
    assert sorted(sample[1]) == sorted("another 3" if k == 3 else f"text {k}" for k in learned if k % 2)
    assert set(sample[0]) == {"" if k == 8 else f"text {k}" for k in learned if k % 2 == 0 and k != 4}
    assert counts == {0: len([k for k in learned if k % 2 == 0 and k != 4]), 1: len([k for k in learned if k % 2]) + int(99 in learned or labels.where("doc_id = 99").where(~held_out("doc_id")).count())}
    few, _ = labelled_sample(docs, labels, "quality", {0: 3, 1: 2})
    assert (len(few[0]), len(few[1])) == (3, 2) and set(few[1]) <= set(sample[1])
    assert all(len(text) <= 6 for text in labelled_sample(docs, labels, "quality", {1: 100}, longest=6)[0][1])


def test_repeats_are_found_whatever_the_number_of_groups(spark, monkeypatch):
    from casemart.llm import substring_dedup

    shared = " ".join(f"s{n}" for n in range(60))
    rows = [(k, " ".join(f"w{k}x{n}" for n in range(30)) + (f" {shared}" if k % 3 == 0 else "")) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plain = sorted(map(tuple, remove_repeats(docs).collect()))
    monkeypatch.setattr(substring_dedup, "_BUCKET", 200)
    assert sorted(map(tuple, remove_repeats(docs).collect())) == plain
    assert all(removed == (60 if i % 3 == 0 else 0) for i, _, removed, _ in plain)
