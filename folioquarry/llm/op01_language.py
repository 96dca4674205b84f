"""Language identification in two steps: the language family, then the language within it.

Families are told apart by linear support vector machines, one against one, and so are the languages
of the family that wins. A text is a vector of hashed byte trigrams and words over letters only, whole
texts, in blocks. The machines are fitted on the driver on at most ``per_language`` labelled texts of
each language; that bound is a parameter, and what is collected is ``DIMENSIONS`` numbers a text.
Prediction is a map without a shuffle: a matrix of one row per machine is all that tasks receive.

Defined results: null texts and texts without a letter are ``und`` with score 0; null labels and null
ids are not learned from but are predicted; repeated rows get a row each; without any labelled text
every prediction is ``und``; with one language only, that language with score 1; of labels that win as many
duels the surer one is taken, then the first by code point; an empty table gives no rows; a text of any length
is read whole, in blocks; further columns are kept, but ``lang_pred`` and ``score`` are replaced.

Many labels. ``MOST_TEXTS`` bounds the texts of all labels together, so more labels have fewer each. Where there are more than ``MOST_FAMILIES`` families, those of one
label are gathered into as many groups as the root of their number, around labels that are far from each other, and a group is a family. Of more labels than ``most_labels`` those
of most texts are learned, the first by code point among equals; the others are predicted as what they are nearest to. Nothing is refused.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import mapped, written
from .wordhash import SEPARATOR, blocks, byte_rows, word_hashes

DIMENSIONS = 1 << 12
PER_LANGUAGE, MOST_LABELS, MOST_TEXTS = 400, 256, 25_600
#: Families above which labels without a known family are gathered into groups.
MOST_FAMILIES = 32
#: The constant feature of the machines, and the scale at which vectors are sent.
BIAS, SCALE = 0.3, 65_535
UNDETERMINED = "und"

# Families of languages by ISO 639-1 code; a language not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nl no nb nn sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "indic": "bn gu hi mr ne pa ur",
    "turkic": "az kk ky tr tt uz",
    "uralic": "et fi hu",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

#: Letters folded to lower case and bytes of longer characters as they are; all else is a break.
_FORM = np.full(256, 32, dtype=np.uint8)
_FORM[97:123] = np.arange(97, 123)
_FORM[65:91] = np.arange(97, 123)
_FORM[128:] = np.arange(128, 256)


def features(data: np.ndarray) -> np.ndarray:
    """The unit vector of a text; zeros if it has no letter."""
    counts = np.zeros(DIMENSIONS)
    for part in blocks(data):
        if not len(part):
            continue
        form = _FORM[part].astype(np.uint32)
        if len(form) > 2:
            h = form[:-2] * np.uint32(0x9E3779B1) + form[1:-1] * np.uint32(0x85EBCA77) + form[2:] * np.uint32(0xC2B2AE3D)
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x27D4EB2F) >> np.uint32(20)
            blank = (form[1:-1] == 32) & ((form[:-2] == 32) | (form[2:] == 32))
            counts += np.bincount(h[~blank], minlength=DIMENSIONS)
        words = word_hashes(_FORM[part])
        if len(words):
            counts += np.bincount((words >> np.uint64(52)).astype(np.int64), minlength=DIMENSIONS)
    counts = np.sqrt(counts)
    norm = np.linalg.norm(counts)
    return counts / norm if norm else counts


def has_letter(data: np.ndarray | None) -> bool:
    if data is None:
        return False
    folded = data | 32
    if bool(((folded >= 97) & (folded <= 122) & (data < 128)).any()):
        return True
    return bool((data >= 128).any()) and any(c.isalpha() for c in data.tobytes().decode("utf-8", "replace"))


def fit_machine(x: np.ndarray, rows: np.ndarray, y: np.ndarray, rounds: int = 30, cost: float = 10.0) -> np.ndarray:
    """A linear support vector machine with squared hinge loss, by dual coordinate descent, on some rows of x.

    y is 1 or -1; the last weight is the bias, whose feature is ``BIAS``. Rows are read in place, never copied.
    """
    weights, alpha = np.zeros(x.shape[1]), np.zeros(len(rows))
    bias, soft = 0.0, 0.5 / cost
    curve = np.array([float(x[i] @ x[i]) for i in rows]) + BIAS * BIAS + soft
    order = np.random.default_rng(7)
    for _ in range(rounds):
        most = 0.0
        for k in order.permutation(len(rows)):
            v = x[rows[k]]
            slope = y[k] * (v @ weights + BIAS * bias) - 1 + alpha[k] * soft
            new = max(0.0, alpha[k] - slope / curve[k])
            step = new - alpha[k]
            if step:
                weights += step * y[k] * v
                bias += step * y[k] * BIAS
                most = max(most, abs(step))
                alpha[k] = new
        if most < 1e-3:
            break
    return np.append(weights, bias)


@dataclass
class Duels:
    """Machines of every pair of labels; a label's confidence is its least in the duels it takes part in."""

    labels: list[str]
    pairs: list[tuple[int, int]]
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, labels: np.ndarray, of: np.ndarray) -> Duels:
        """``labels`` of the rows ``of`` x."""
        names = sorted(set(labels))
        pairs, machines = list(combinations(range(len(names)), 2)), []
        for a, b in pairs:
            some = (labels == names[a]) | (labels == names[b])
            machines.append(fit_machine(x, of[some], np.where(labels[some] == names[a], 1.0, -1.0)))
        return cls(names, pairs, np.array(machines).reshape(len(pairs), DIMENSIONS + 1))

    def decide(self, v: np.ndarray) -> tuple[str, float]:
        if len(self.labels) == 1:
            return self.labels[0], 1.0
        margin = self.weights[:, :-1] @ v + BIAS * self.weights[:, -1]
        sure = 1 / (1 + np.exp(-3 * np.clip(margin, -20, 20)))
        wins, least = np.zeros(len(self.labels)), np.ones(len(self.labels))
        for (a, b), p in zip(self.pairs, sure, strict=True):
            wins[a] += p >= 0.5
            wins[b] += p < 0.5
            least[a], least[b] = min(least[a], p), min(least[b], 1 - p)
        best = max(range(len(self.labels)), key=lambda i: (wins[i], least[i]))
        return self.labels[best], float(least[best])


def families_of(x: np.ndarray, langs: np.ndarray) -> np.ndarray:
    """The family of each row: that of its label, or, where there are too many families, that of the group of like labels that its label is in."""
    names = sorted(set(langs))
    family = {lang: FAMILY_OF.get(lang, lang) for lang in names}
    alone = [lang for lang in names if list(family.values()).count(family[lang]) == 1]
    if len(set(family.values())) > MOST_FAMILIES:
        means = np.array([x[langs == lang].mean(axis=0) for lang in alone])
        means /= np.linalg.norm(means, axis=1, keepdims=True)
        likeness = means @ means.T
        heads = [0]
        while len(heads) < round(len(alone) ** 0.5):  # the label that is least like the heads so far, the first of equals
            heads.append(int(likeness[heads].max(axis=0).argmin()))
        nearest = likeness[heads].argmax(axis=0)
        family |= {lang: f"like {alone[heads[k]]}" for lang, k in zip(alone, nearest, strict=True)}
    return np.array([family[lang] for lang in langs])


@dataclass
class LanguageModel:
    families: Duels | None
    languages: dict[str, Duels]

    @classmethod
    def fit(cls, x: np.ndarray, labels: list[str]) -> LanguageModel:
        if not labels:
            return cls(None, {})
        langs, rows = np.array(labels), np.arange(len(labels))
        family = families_of(x, langs)
        return cls(Duels.fit(x, family, rows), {f: Duels.fit(x, langs[family == f], rows[family == f]) for f in sorted(set(family))})

    def predict(self, data: np.ndarray | None) -> tuple[str, float]:
        if self.families is None or not has_letter(data):
            return UNDETERMINED, 0.0
        v = features(data)
        family, a = self.families.decide(v)
        language, b = self.languages[family].decide(v)
        return language, a * b


def held_out(doc_id: Column) -> Column:
    """Documents not learned from: a third, by their id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _vectors(batches):
    import pyarrow as pa

    for batch in batches:
        vectors = [np.rint(features(d) * SCALE).astype(np.uint16).tobytes() for d in byte_rows(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vectors, pa.binary())], names=["lang", "vector"])


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE, most_labels: int = MOST_LABELS) -> LanguageModel:
    """Fits on at most ``per_language`` texts of each of the ``most_labels`` labels of most texts, those least by a hash of id and text."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(most_labels).collect()}
    if not counts:
        return LanguageModel.fit(np.empty((0, DIMENSIONS)), [])
    per_language = max(1, min(per_language, MOST_TEXTS // len(counts)))
    # a share by hash of about three times what is wanted keeps the ranking small; no sort of all rows
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, 3.0 * per_language / n + 1e-9))).otherwise(share)
    place = F.xxhash64("doc_id", F.lit(11))
    drawn = labelled.where(F.pmod(place, F.lit(1_000_000)) < share * 1_000_000).select("lang", "text", place.alias("place"), F.xxhash64("text").alias("h"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("place", "h"))
    chosen = drawn.withColumn("nth", nth).where(F.col("nth") <= per_language).select("lang", "text")
    sent = written(mapped(chosen, _vectors, "lang string, vector binary")).orderBy("lang", "vector")
    labels, x = [], np.zeros((sum(min(n, per_language) for n in counts.values()), DIMENSIONS), dtype=np.float32)
    for r in sent.toLocalIterator():
        x[len(labels)] = np.frombuffer(r["vector"], dtype=np.uint16)
        if x[len(labels)].any():  # else the row is filled anew: a text without a letter teaches nothing
            labels.append(r["lang"])
    x /= SCALE
    return LanguageModel.fit(x[: len(labels)], labels)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with lang_pred and score."""
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    at = names.index("text")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = [model.predict(d) for d in byte_rows(batch.column(at))]
            more = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*names, "lang_pred", "score"])

    schema = docs.select(*names).withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0)).schema
    return mapped(docs.select(*names), run, schema)


def language_rows(docs: DataFrame) -> DataFrame:
    """The rows of query op1."""
    model = learn(docs)
    return identify(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), model).drop("text")
