"""Toxicity by a classifier that counterfactual pairs regularise.

In sentences of labelled texts each identity term is swapped for its counterpart
and for a neutral word of its language; a text without any gets a mention of a
group. The change of the score that such a swap makes is penalised next to the
logistic loss. What tells groups apart, or from no group, then can't carry the
score, nor can the starts of words that group names share with insults, so
neutral mentions of a group aren't flagged.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainledger.llm.frames import crc, per_batch, settled
from rainledger.llm.labelled import sample

#: Labelled rows that the weights are fitted on at most, terms in the model at most, lengths of the starts of words.
FIT_ROWS, TERMS, STARTS = 16_000, 2500, (3, 4, 5)
#: Counterparts, by language: each term of a pair is swapped for the other, or for the neutral word of its language.
PAIRS = {
    "people": (
        "women/men woman/man girls/boys girl/boy muslim/christian muslims/christians jewish/hindu jews/hindus buddhist/atheist buddhists/atheists black/white asian/european african/american "
        "latino/indian arab/western gay/straight lesbian/heterosexual transgender/cisgender immigrant/citizen immigrants/citizens refugee/resident refugees/residents elderly/young disabled/healthy blind/sighted deaf/hearing poor/rich"
    ),
    "personnes": "femmes/hommes femme/homme filles/garçons musulmans/chrétiens musulman/chrétien juifs/hindous noirs/blancs africains/européens asiatiques/américains homosexuels/hétérosexuels immigrés/citoyens réfugiés/habitants pauvres/riches handicapés/valides vieux/jeunes",
    "menschen": "frauen/männer frau/mann mädchen/jungen muslime/christen juden/hindus schwarze/weiße afrikaner/europäer asiaten/amerikaner schwule/lesben einwanderer/bürger flüchtlinge/einwohner arme/reiche alte/junge behinderte/gesunde",
    "personas": "mujeres/hombres mujer/hombre niñas/niños musulmanes/cristianos judíos/hindúes negros/blancos africanos/europeos asiáticos/americanos homosexuales/heterosexuales inmigrantes/ciudadanos refugiados/vecinos pobres/ricos ancianos/jóvenes discapacitados/sanos",
}

_words = re.compile(r"\w+").findall
_sentences = re.compile(r"[^.!?\n]+").findall


def terms(text: str) -> set[str]:
    """A text's lower-case words, and the starts of its longer words (with a trailing hyphen)."""
    words = set(_words(text.lower()))
    return words.union(*({f"{w[:n]}-" for w in words if len(w) > n} for n in STARTS))


def swaps_of(pairs: dict[str, str] = PAIRS) -> dict[str, tuple[str, str]]:
    """term -> its counterpart and its language's neutral word."""
    out = {}
    for neutral, said in pairs.items():
        for a, b in (x.split("/") for x in said.split()):
            out.setdefault(a, (b, neutral))
            out.setdefault(b, (a, neutral))
    return out


def _term_counts(words: list[str]) -> Counter[str]:
    found = Counter(words)
    out = Counter(found)
    for w, k in found.items():
        for n in STARTS:
            if len(w) > n:
                out[f"{w[:n]}-"] += k
    return out


def swapped(text: str, swaps: dict[str, tuple[str, str]], ring: list[str]) -> list[tuple[set[str], set[str]]]:
    """What each swap brings to a text's terms, and takes from them: in each of its sentences with an identity term, all such terms for their counterparts, and all for the neutral words; in a text without any, a mention of one term of the ring, chosen by the text's hash."""
    text = text.lower()
    words = _words(text)
    if swaps.keys().isdisjoint(words):
        return [(terms(ring[zlib.crc32(text.encode()) % len(ring)]) - _term_counts(words).keys(), set())] if ring else []
    all_, out = _term_counts(words), []
    for sentence in map(_words, _sentences(text)):
        if swaps.keys().isdisjoint(sentence):
            continue
        own = _term_counts(sentence)
        for k in (0, 1):
            new = _term_counts([swaps[w][k] if w in swaps else w for w in sentence]).keys()
            out.append((new - all_.keys(), {t for t, n in own.items() if all_[t] == n and t not in new}))
    return out


def fit(rows: list[np.ndarray], y: np.ndarray, swaps: list[tuple[int, np.ndarray, np.ndarray]], n_terms: int, ridge: float = 0.02, fairness: float = 5.0, turns: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias of the logistic loss, a ridge and the squared score changes of the swaps; gradient steps with momentum.

    rows: term numbers of each text; swaps: (row, term numbers that come, those that go). What a swap leaves as it is doesn't slow its terms down.
    """
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    index = np.concatenate(rows) if len(rows) else np.zeros(0, np.int64)
    changed = [(a, b) for _, a, b in swaps]
    pair_owner = np.repeat(np.arange(len(swaps)), [len(a) + len(b) for a, b in changed]) if swaps else np.zeros(0, np.int64)
    pair_index = np.concatenate([x for both in changed for x in both]) if swaps else np.zeros(0, np.int64)
    pair_sign = np.concatenate([np.r_[np.ones(len(a)), -np.ones(len(b))] for a, b in changed]) if swaps else np.zeros(0)
    each = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    weights, bias, speed, lean = np.zeros(n_terms), 0.0, np.zeros(n_terms), 0.0
    often = np.bincount(index, weights=each[owner], minlength=n_terms)
    rate = 1 / (0.25 * (often * 6 + 1e-3) + ridge * 1e-2 + fairness * np.bincount(pair_index, minlength=n_terms) / max(len(swaps), 1))
    for _ in range(turns):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(owner, weights=weights[index], minlength=len(rows)) + bias, -30, 30)))
        error = each * (p - y)
        slope = np.bincount(index, weights=error[owner], minlength=n_terms) + ridge * 1e-2 * weights
        if swaps:
            change = np.bincount(pair_owner, weights=weights[pair_index] * pair_sign, minlength=len(swaps))
            slope += fairness * np.bincount(pair_index, weights=change[pair_owner] * pair_sign, minlength=n_terms) / len(swaps)
        speed = 0.8 * speed - 0.2 * rate * slope
        lean = 0.8 * lean - 0.2 * 2 * error.sum()
        weights, bias = weights + speed, bias + lean
    return weights, bias


def model(labelled: DataFrame, pairs: dict[str, str] = PAIRS, most_terms: int = TERMS, fairness: float = 5.0) -> tuple[dict[str, float], float]:
    """Weights of terms, and the bias, from (text, label) rows of a bounded number."""
    groups = swaps_of(pairs)

    def spread(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [(t, y) for x, y in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()) for t in terms(x)]
        return pa.RecordBatch.from_arrays([pa.array([t for t, _ in found], pa.string()), pa.array([y for _, y in found], pa.int32())], ["term", "label"])

    sizes = {r.label: r["count"] for r in labelled.groupBy("label").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return {}, -1.0
    share = F.lit(sizes[1] / (sizes[0] + sizes[1]))
    counts = per_batch(labelled.select("text", "label"), spread, "term string, label int").groupBy("term").agg(F.count("*").alias("n"), F.sum("label").alias("bad"))
    high, low = (F.col("bad") + share) / (F.col("n") + 1), (F.col("n") - F.col("bad") + 1 - share) / (F.col("n") + 1)
    gain = F.abs(F.col("bad") * F.log(high / share) + (F.col("n") - F.col("bad")) * F.log(low / (1 - share)))
    seen = {r.term for r in counts.where(F.col("term").isin(*groups)).select("term").collect()} if groups else set()
    ring = sorted({x for t in seen or groups for x in (t, *groups[t])})  # of groups that the sample mentions, if it mentions any
    known = sorted({r.term for r in counts.where("n >= 3").orderBy(gain.desc(), "term").limit(most_terms).collect()} | {t for w in (*groups, *pairs) for t in terms(w)})
    number = {t: i for i, t in enumerate(known)}

    def numbered(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, swaps = [], []
        for x in batch.column("text").to_pylist():
            found = terms(x)
            rows.append(sorted(number[t] for t in found if t in number))
            swaps.append([{k: sorted(number[t] for t in s if t in number) for k, s in zip("ab", both)} for both in swapped(x, groups, ring)])
        inner = pa.list_(pa.int32())
        return pa.RecordBatch.from_arrays([batch.column("label"), pa.array(rows, inner), pa.array(swaps, pa.list_(pa.struct([("a", inner), ("b", inner)])))], ["label", "x", "swaps"])

    read = per_batch(labelled.select("label", "text"), numbered, "label int, x array<int>, swaps array<struct<a:array<int>,b:array<int>>>").orderBy("label", "x").collect()
    rows = [np.array(r.x, np.int64) for r in read]
    swaps = [(i, np.array(s.a, np.int64), np.array(s.b, np.int64)) for i, r in enumerate(read) for s in r.swaps]
    weights, bias = fit(rows, np.array([r.label for r in read]), swaps, len(known), fairness=fairness)
    return {t: float(w) for t, w in zip(known, weights) if w}, bias


def toxicity_scores(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, held_out: int = 0, at: float = 0.5, fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 if score >= at) of each row of docs; with carry, these columns of docs in the place of doc_id.

    The model is fitted on at most fit_rows labelled rows of the other folds (a
    bounded sample by design). A score depends on nothing but the whole text:
    null counts as empty, equal texts have equal scores. Rows without an id are
    scored and are in no held-out fold. Without labels of both kinds each score
    is below `at`. Repeated rows stay; other columns aren't read; an empty
    table gives no rows.
    """
    weights, bias = model(settled(sample(docs, labels, label, folds, held_out, fit_rows, id_col, text_col)))
    words = {t: w for t, w in weights.items() if not t.endswith("-")}
    starts = {t[:-1]: w for t, w in weights.items() if t.endswith("-")}

    def strength(text: str) -> float:
        found = set(_words(text.lower()))
        return sum(map(words.__getitem__, found & words.keys())) + sum(sum(map(starts.__getitem__, {w[:n] for w in found if len(w) > n} & starts.keys())) for n in STARTS)

    def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
        text = batch.column("id").field(text_col) if inside else batch.column("text")
        raw = np.array([strength(x or "") for x in text.to_pylist()]) + bias
        value = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
        return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held_out"), pa.array(value), pa.array((value >= at).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    whole = F.struct(*carry) if carry else F.col(id_col)
    inside = bool(carry) and text_col in carry  # then the text goes to Python once
    rows = docs.select(whole.alias("id"), *([] if inside else [F.col(text_col).alias("text")]), F.coalesce(crc(F.col(id_col)) % folds == held_out, F.lit(False)).alias("held_out"))
    kind = rows.schema["id"].dataType.simpleString()
    found = per_batch(rows, scored, f"doc_id {kind}, held_out boolean, score double, predicted int")
    return found.select("doc_id.*", "held_out", "score", "predicted") if carry else found
