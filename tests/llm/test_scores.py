import random
import zlib

import numpy as np

from rainledger.llm import quality, toxicity
from rainledger.llm.quality import quality_scores
from rainledger.llm.toxicity import swapped, terms, toxicity_scores

DICE = random.Random(7)
PLAIN = "rain river depth well district season level month water field".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double"
LABELS = "doc_id long, quality int, toxic int, score double"


def corpus(n=600):
    docs, labels = [], []
    for i in range(n):
        words = [w + str(DICE.randrange(9)) * (DICE.random() < 0.1) for w in DICE.choices(PLAIN, k=DICE.randrange(20, 80))]
        junk, bad = DICE.random() < 0.3, DICE.random() < 0.3
        if junk:
            words = [words[0]] * len(words)
        if bad:
            words[DICE.randrange(len(words))] = DICE.choice(["vilest", "awful", "muck"])
        if DICE.random() < (0.6 if bad else 0.05):
            words.append("muslim")
        docs.append((i, " ".join(words), "en", "s", 1, 0.0))
        labels.append((i, int(not junk), int(bad), 1.0))
    return docs, labels


def check(spark, f, label, folds, held_out):
    docs, labels = corpus()
    odd = [(None, None, None, None, None, None), (10_001, "", "en", "s", 0, 0.0), (10_002, None, "en", "s", 0, 0.0), (10_003, "rain " * 50_000, "en", "s", 1, 0.0), (5, docs[5][1], "en", "s", 1, 0.0)]
    frames = spark.createDataFrame(docs + odd, DOCS), spark.createDataFrame([*labels, (None, 1, 1, 0.0), (7, None, None, 0.0)], LABELS)
    rows = f(*frames).collect()
    assert len(rows) == len(docs) + len(odd)
    truth = {r[0]: r[1 if label == "quality" else 2] for r in labels}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % folds == held_out) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= (0.7 if label == "quality" else 0.5)) for r in rows)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.93
    by = {r.doc_id: r for r in rows}
    assert by[10_001].score == by[10_002].score
    assert f(frames[0].limit(0), frames[1]).collect() == []
    alone = f(frames[0], frames[1].limit(0)).collect()
    assert len(alone) == len(rows) and len({r.score for r in alone}) == 1
    return frames


def test_quality(spark):
    check(spark, quality_scores, "quality", 4, 2)


def test_toxicity(spark):
    check(spark, toxicity_scores, "toxic", 5, 0)


def test_pairs_fit_puts_the_threshold_at_the_quantile():
    dice = np.random.default_rng(1)
    y = (dice.random(500) < 0.8).astype(int)
    x = dice.normal(size=(500, 4)) + y[:, None] * [3, 0, 0, 0]
    weights, threshold = quality.fit(x, y, 4000)
    share = (quality.widened(x) @ weights >= threshold).mean()
    assert abs(share - y.mean()) < 0.01


def test_swaps_lower_the_weight_of_group_words(spark):
    docs, labels = corpus(800)
    rows = [(d[1], x[2]) for d, x in zip(docs, labels)]
    df = spark.createDataFrame(rows, "text string, label int")
    free, _ = toxicity.model(df, fairness=0.0)
    fair, bias = toxicity.model(df, fairness=5.0)
    assert abs(fair.get("muslim", 0) - fair.get("people", 0)) < 0.2 * abs(free["muslim"])
    group = {t for t in fair if t.rstrip("-") in "muslims"}
    assert sum(fair.get(t, 0) for t in terms("the muslim family at the river")) + bias < 0 and group


def test_swapped():
    swaps = toxicity.swaps_of()
    (one, lost), (none, _) = swapped("A gay poet. The straight road, a gay day", swaps, [])[:2]
    assert "straight" not in one and "gay" not in lost and "people" in none  # only the first sentence is swapped, and both words still stand
    assert len(swapped("A gay poet. The straight road", swaps, [])) == 4
    ((added, gone),) = swapped("A poet at the river", swaps, ["gay", "people"])
    assert added & {"gay", "people"} and not gone
    assert swaps["frauen"] == ("männer", "menschen") and all(swaps[b][0] == a or a in ("", b) or b in swaps for a, (b, _) in swaps.items())
    assert swapped("x", {}, []) == []


def test_every_sentence_is_swapped_as_the_whole_text_says():
    swaps, dice = toxicity.swaps_of(), random.Random(5)
    for _ in range(60):
        sentences = [" ".join(dice.choices(["gay", "women", "men", "rich", "gayest", "womanly", "the", "river", "menace", "straight"], k=dice.randrange(1, 7))) for _ in range(dice.randrange(1, 14))]
        got = swapped(". ".join(sentences), swaps, [])
        want = []
        for i, x in enumerate(sentences):
            for k in (0, 1):
                other = " ".join(swaps[w][k] if w in swaps else w for w in x.split())
                if set(x.split()) & swaps.keys():
                    before, after = terms(". ".join(sentences)), terms(". ".join([*sentences[:i], other, *sentences[i + 1 :]]))
                    want.append((after - before, before - after))
        assert got == want


def test_labels_of_one_kind(spark):
    docs, labels = corpus(60)
    df = spark.createDataFrame(docs, DOCS)
    for quality_label, toxic in ((1, 0), (0, 1)):
        same = spark.createDataFrame([(i, quality_label, toxic, 1.0) for i, *_ in labels], LABELS)
        for f in (quality_scores, toxicity_scores):
            rows = f(df, same).collect()
            assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows) and len({r.predicted for r in rows}) == 1


def test_neutral_mentions_are_flagged_less_often(spark):
    """Held-out clean texts with a mention of a group: how many are flagged without and with the counterfactual pairs."""
    dice = random.Random(3)
    rows = []
    for i in range(1200):
        bad = dice.random() < 0.3
        words = dice.choices(PLAIN, k=30) + ([dice.choice(["vilest", "awful"]) if dice.random() < 0.5 else f"q{i}"] if bad else [])
        words += ["muslim"] * (dice.random() < (0.8 if bad else 0.05))
        dice.shuffle(words)
        rows.append((" ".join(words), int(bad)))
    fit, held = rows[:800], [t for t, y in rows[800:] if not y and "muslim" not in t]
    df = spark.createDataFrame(fit, "text string, label int")
    flagged = {}
    for fairness in (0.0, 5.0):
        weights, bias = toxicity.model(df, fairness=fairness)
        flagged[fairness] = np.mean([sum(weights.get(t, 0) for t in terms(x + " muslim")) + bias > 0 for x in held])
    assert flagged[0.0] > 0.5 and flagged[5.0] < 0.1, flagged
