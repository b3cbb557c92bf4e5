"""Quality rules, the weakly labelled classifier and decontamination."""

import os

import numpy as np
import pytest

from fieldlens.llm import decontaminate, quality_rules, queries, weak_quality
from tests.llm import brute

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
CLEAN = " ".join(f"word{i} of text" for i in range(20))


def test_rules_odd_rows(spark):
    texts = [None, "", " \n\t ", CLEAN, CLEAN, "a b c", "SHOUT " + CLEAN.upper(), "ab cd ef gh ij kl mn op " * 9, " ".join(f"##{i}" for i in range(40)) + " " + CLEAN,
             "x" * 100_000 + " " + CLEAN, "\n".join(["the same line again"] * 9 + [CLEAN]), "é\U0001F600 " * 30, "tik tik tok tok " * 3 + CLEAN]
    df = spark.createDataFrame([(i if i != 4 else None, t, "w", 5) for i, t in enumerate(texts)], "doc_id long, text string, words string, n_words int")
    rows = {r.text if r.doc_id is not None else "null id": r for r in quality_rules.apply_rules(df).collect()}
    assert len(rows) == len(texts) and rows[CLEAN].words == "w"
    for t in texts:
        r, w = rows[t], brute.words(t)
        lines = [line for line in (t or "").split("\n") if brute.words(line)]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), brute.repeat_words(t))
        assert r.base_failed == (len(w) < 20 or 100 * r.n_repeat_words > 30 * len(w))
        assert r.kept == (r.failed_rule is None) and not (r.base_failed and r.kept)
    assert rows[CLEAN].kept and rows["null id"].kept
    assert rows[texts[6]].failed_rule == "capitals" and rows[texts[8]].failed_rule == "symbols"
    assert quality_rules.apply_rules(df.limit(0)).count() == 0


def test_rule_order_does_not_change_the_verdict(spark):
    df = spark.createDataFrame([(i, CLEAN if i % 3 else "### " * 40) for i in range(60)], "doc_id long, text string")
    ordered = quality_rules.order_rules(df)
    assert sorted(r.name for r in ordered) == sorted(r.name for r in quality_rules.RULES)
    assert quality_rules.order_rules(df.limit(0)) == list(quality_rules.RULES)
    one = {r.doc_id: r.kept for r in quality_rules.apply_rules(df, ordered).collect()}
    assert one == {r.doc_id: r.kept for r in quality_rules.apply_rules(df, ordered[::-1]).collect()}


def test_rule_that_rejects_cheaply_runs_first(spark):
    df = spark.createDataFrame([(i, CLEAN * 40) for i in range(200)], "doc_id long, text string")
    slow = quality_rules.Rule("slow", "size(filter(words, (w, i) -> exists(slice(words, 1, 200), v -> v = concat(w, '!')))) > 0")
    always = quality_rules.Rule("always", "n_words > 0")
    assert quality_rules.order_rules(df, (slow, always))[0].name == "always"


def test_em_recovers_labeller_accuracies():
    """Simulated labellers of known accuracy: posteriors separate the classes
    and a random labeller moves nothing."""
    rng = np.random.default_rng(5)
    bad = rng.random(20_000) < 0.2
    hit = [(0.9, 0.02), (0.8, 0.05), (0.7, 0.1), (0.5, 0.5)]
    votes = [np.where(rng.random(len(bad)) < np.where(bad, a, b), weak_quality.BAD, weak_quality.GOOD) for a, b in hit]
    code = sum(v * 3 ** (3 - i) for i, v in enumerate(votes))
    patterns = dict(zip(*(x.tolist() for x in np.unique(code, return_counts=True))))
    posterior = weak_quality.estimate(patterns, 4)
    said = np.array([posterior[c] for c in code.tolist()]) > 0.5
    assert (said == bad).mean() > 0.95
    flipped = [abs(posterior[c] - posterior[c ^ 3]) for c in patterns if c % 3 == 1 and c + 1 in patterns and (c ^ 3) == c + 1]
    assert not flipped or max(flipped) < 0.2
    assert weak_quality.estimate({}, 4) == {}


@needs_data
def test_classifier_on_held_out_labels(spark):
    """Fitted on half of the labels, judged on the other half."""
    sf = SF.replace("0.001", "0.1") if os.path.isdir(SF.replace("0.001", "0.1")) else SF
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = weak_quality.fit(docs, labels.where("doc_id % 2 = 0"))
    held = labels.where("doc_id % 2 = 1").join(weak_quality.score(docs, model, carry=["doc_id"]), "doc_id").collect()
    clean = [r.kept for r in held if r.quality == 1 and r.toxic == 0]
    junk = [r.kept for r in held if r.quality == 0]
    toxic = [r.kept for r in held if r.toxic == 1]
    assert np.mean(clean) > 0.98 and np.mean(junk) < 0.05 and np.mean(toxic) < 0.12


@needs_data
def test_scores_match_a_fixed_model_row_by_row(spark):
    """Scores of every whole text recomputed from the model's weights."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, " \n"), (-4, "\u00c9t\u00e9 \U0001F600 #tag! tag"), (-5, "A " * 3000), (-6, CLEAN.upper())], docs.schema)
    docs = docs.union(odd)
    model = weak_quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert len(model.junk.ids) and len(model.toxic.ids)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = weak_quality.score(docs, model).collect()
    assert len(rows) == len(texts)
    for r in rows:
        found = brute.fault_features(texts[r.doc_id])
        junk, toxic = (brute.logistic(found, m.ids.tolist(), m.weights.tolist(), m.bias) for m in (model.junk, model.toxic))
        if not brute.words(texts[r.doc_id]):
            junk = 1.0
        assert (r.junk_score, r.toxic_score) == pytest.approx((junk, toxic), abs=1e-9)
        assert r.kept == (junk < 0.5 and toxic < 0.5)


def test_dropped_copies_do_not_weaken_the_words_of_the_rest(spark):
    """A word of 20 of 100 bad rows and no good one; 2666 copies of another
    bad text were picked but are not in the sample."""
    rows = [(i, [7] if i < 20 else [8 if i >= 100 else 9]) for i in range(5334)]
    sample = spark.createDataFrame(rows, "doc long, ids array<long>")
    soft = {i: float(i < 100 or i >= 5334) for i in range(8000)}
    scorer = weak_quality._scorer(spark, sample, soft, 1024)
    assert 7 in scorer.ids.tolist()
    assert scorer(np.array([0]), np.array([7]), 1)[0] > 0.5


def test_few_toxic_labels_still_count(spark):
    """Five toxic labels in 87 whose rows share words, and a single one."""
    rng = np.random.default_rng(11)
    texts = [" ".join(f"w{int(x)}" for x in rng.integers(0, 400, 60)) for _ in range(200)]
    for i in (3, 17, 40, 61, 80, 120, 150):
        texts[i] += " vileword nastything"
    texts[3] += " " + " ".join(f"own{i}" for i in range(16))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for toxic, more in (({3, 17, 40, 61, 80}, {120, 150}), ({3}, set())):
        labels = spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(87) if i in toxic or i not in (3, 17, 40, 61, 80)],
                                       "doc_id long, quality int, toxic int")
        rows = weak_quality.score(docs, weak_quality.fit(docs, labels), carry=["doc_id"]).collect()
        dropped = {r.doc_id for r in rows if r.toxic_score >= 0.5}
        assert toxic | more <= dropped and len(dropped) <= 10


def test_classifier_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, "k"), (2, "", "k"), (None, CLEAN, None), (3, CLEAN, "k"), (3, CLEAN, "k"), (4, "w " * 50_000, "k")],
                                 "doc_id long, text string, kept string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(3, 1, 0), (3, 0, None), (None, 1, 1), (99, 7, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, some):
        model = weak_quality.fit(docs, labels)
        rows = weak_quality.score(docs, model).collect()
        assert len(rows) == 6 and all(0 <= r.toxic_score <= 0.5 for r in rows)
        assert all(r.kept is False for r in rows if not brute.words(r.text))
    model = weak_quality.fit(docs.limit(0), none)
    assert weak_quality.score(docs.limit(0), model).count() == 0


@needs_data
def test_leaks_match_brute_force(spark):
    sf = SF.replace("0.001", "0.01")
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").where("doc_id % 4 = 0").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    want = brute.leaks(docs, items)
    got = {(r.doc_id, r.item_id): (r.similarity, r.first_word) for r in queries.op3_decontamination(spark, sf).collect()}
    assert {k: v for k, v in got.items() if k[0] % 4 == 0} == want and want


def edited(words, places):
    return [w if i not in places else "edited" for i, w in enumerate(words)]


def test_leaks_near_copies_and_odd_rows(spark):
    """Edited copies on both sides of the threshold, short and empty items,
    items repeated in a text, several blocks of items."""
    rng = np.random.default_rng(7)
    item = [f"w{int(x)}" for x in rng.integers(0, 50, 60)]
    noise = [f"n{i}" for i in range(300)]
    bodies = [" ".join(noise[:100] + edited(item, places) + noise[100:]) for places in ((), (0,), (30,), (10, 30), (0, 59), (1, 20, 40))]
    bodies += [" ".join(item[:50]), " ".join(item[5:]), " ".join(item + item), " ".join(w.upper() + "," for w in item), None, "", "tiny item", "x tiny item y"]
    docs = dict(enumerate(bodies))
    items = {1: " ".join(item), 2: "tiny item", 3: "", 4: None, 5: " ".join(noise[:20])}
    ddf = spark.createDataFrame([(i, t, "h") for i, t in docs.items()] + [(None, bodies[0], "h")], "doc_id long, text string, item_id string")
    idf = spark.createDataFrame(list(items.items()) + [(1, " ".join(item)), (None, " ".join(item))], "item_id long, text string")
    want = brute.leaks({i: t or "" for i, t in docs.items()}, {i: t or "" for i, t in items.items()})
    for block in (4096, 1):
        got = {(r.doc_id, r.item_id): (r.similarity, r.first_word) for r in decontaminate.find_leaks(ddf, idf, block_items=block).collect() if r.doc_id is not None}
        assert got == want
    kept = decontaminate.drop_leaks(ddf, idf)
    assert kept.columns == ddf.columns
    assert {r.doc_id for r in kept.collect()} == set(docs) - {d for d, _ in want}
    assert decontaminate.find_leaks(ddf.limit(0), idf).count() == 0 and decontaminate.find_leaks(ddf, idf.limit(0)).count() == 0
    assert decontaminate.drop_leaks(ddf, idf.limit(0)).count() == len(docs) + 1


def test_leaks_of_null_and_repeated_ids(spark):
    """An item with a null id (or none) still drops documents; documents with
    a null id and repeated rows keep their own leaks, over several blocks."""
    item, more = " ".join(f"w{i}" for i in range(30)), " ".join(f"v{i}" for i in range(30))
    docs = spark.createDataFrame([(1, f"a {item}"), (2, "clean text"), (None, f"b c {item}"), (None, item), (3, item), (3, item), (3, f"x {item}")],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(None, item)], "item_id long, text string")
    for known in (items, items.select("text"), items.union(spark.createDataFrame([(7, more)], items.schema))):
        assert [r.doc_id for r in decontaminate.drop_leaks(docs, known).collect()] == [2]
    known = spark.createDataFrame([(5, item), (5, item + " tail"), (6, more)], "item_id long, text string")
    for block in (4096, 1):
        got = [(r.doc_id, r.item_id, r.similarity, r.first_word) for r in decontaminate.find_leaks(docs, known, block_items=block).collect()]
        want = [(None, 0), (None, 2), (1, 1), (3, 0), (3, 0), (3, 1)]
        assert sorted(((d, w) for d, i, alike, w in got if (i, alike) == (5, 1.0)), key=repr) == sorted(want, key=repr) and len(got) == len(want)


def test_hamming_index_finds_all_within_radius():
    rng = np.random.default_rng(8)
    values = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    index = decontaminate.HammingIndex(values, 19)
    for q in rng.choice(values, 20):
        for flips in (0, 5, 19, 20):
            query = int(q) ^ sum(1 << int(b) for b in rng.choice(64, flips, replace=False))
            want = np.flatnonzero(np.bitwise_count(values ^ np.uint64(query)) <= 19)
            assert index.within(query).tolist() == want.tolist()
