"""Language identification in two steps: the family first, then the language within it.

A text is a vector of hashed byte n-grams (2 to 4 bytes; A-Z count as a-z, whatever is no
letter and no byte beyond ASCII counts as a blank, and runs of blanks as one). Counts enter
by their square roots, scaled to length one, so a line said a thousand times does not decide
alone. One linear support vector machine per family, against all others, names the family.
Within it there is a machine for each two languages, fitted on those two only; each
machine votes, the language with most votes wins, and equal votes go by the sum of margins.

Families are a parameter: which languages are closely related is known, not learned.
Languages that no family lists are families of their own.

The machines are fitted on the driver, by coordinate descent on the dual problem, from a
bounded sample: about ``sample`` documents chosen by a hash of the id, shared equally between
the languages. Whole texts are read, in training and in prediction.

Defined cases: a null text or one without a letter is ``und`` with score 0, and so is
every text when nothing was learned; with one language every other text is in it, with
score 1; rows without id or language teach nothing; repeated rows are rows of their own;
columns of the input with the names of the results give way to them; an empty table gives
no rows; of equal votes and margins the first in alphabetical order wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from docstrata.llm.tables import disclose, enclose, inner, pick
from docstrata.llm.words import buffers, chunks

#: Documents that the machines are fitted on, of all languages together.
SAMPLE = 2000
BUCKETS = 1 << 13
SIZES = (2, 3, 4)
UNDETERMINED = "und"
#: Closely related languages, by ISO 639-1 code.
FAMILIES = {
    "germanic": ("de", "en", "nl", "af", "sv", "da", "no", "nb", "nn", "is"),
    "romance": ("es", "fr", "it", "pt", "ca", "gl", "ro"),
    "slavic": ("ru", "uk", "be", "bg", "mk", "sr", "hr", "bs", "sl", "cs", "sk", "pl"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "mr", "ne", "bn", "ur", "pa", "gu"),
}
_BLANK = 32
_ROWS = 128
_SLICE = 1 << 19


def _fold() -> np.ndarray:
    table = np.full(256, _BLANK, np.uint32)
    table[128:] = np.arange(128, 256)
    for small, large in zip(range(ord("a"), ord("z") + 1), range(ord("A"), ord("Z") + 1), strict=True):
        table[small] = table[large] = small
    return table


_FOLD = _fold()


def count_grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of bucket counts for each text. Bytes are read in slices of bounded size;
    an n-gram counts in the slice it starts in."""
    rows = len(offsets) - 1
    out = np.zeros((rows, BUCKETS), np.int64)
    reach = max(SIZES)
    for low in range(0, len(data), _SLICE):
        high = min(low + _SLICE, len(data))
        part = _FOLD[data[low : min(high + reach - 1, len(data))]]
        row = np.repeat(np.arange(rows), np.diff(np.clip(offsets, low, low + len(part))))
        # No n-gram goes from one text into the next or over two blanks.
        joined = (row[1:] == row[:-1]) & ~((part[1:] == _BLANK) & (part[:-1] == _BLANK))
        gram, whole = part, np.ones(len(part), bool)
        for size in range(2, reach + 1):
            gram = (gram[:-1] << np.uint32(8)) | part[size - 1 :]
            whole = whole[:-1] & joined[size - 2 :]
            if size not in SIZES:
                continue
            starts = min(high - low, len(gram))
            own = whole[:starts]
            key = bucket(gram[:starts][own], size) + row[:starts][own] * BUCKETS
            out += np.bincount(key, minlength=out.size).reshape(out.shape)
    return out


def bucket(grams: np.ndarray, size: int) -> np.ndarray:
    """Where n-grams of one size, given as numbers of their bytes, are counted."""
    mixed = (grams + np.uint32(size)) * np.uint32(2654435761)
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(2246822519)
    return (mixed >> np.uint32(32 - (BUCKETS - 1).bit_length())).astype(np.int64)


def profiles(texts: pa.Array) -> Iterator[np.ndarray]:
    """Vectors of ranges of texts: square roots of counts, of length one (or zero)."""
    data, offsets = buffers(texts)
    for low, high in chunks(offsets):
        for first in range(low, high, _ROWS):
            last = min(first + _ROWS, high)
            own = offsets[first : last + 1]
            counts = count_grams(data[own[0] : own[-1]], own - own[0])
            total = counts.sum(axis=1, keepdims=True)
            yield np.sqrt(counts / np.maximum(total, 1)).astype(np.float32)


def machine(x: np.ndarray, good: np.ndarray, cost: float = 10.0, rounds: int = 40) -> np.ndarray:
    """Weights, the last one constant, of a linear support vector machine with squared
    hinge loss, by coordinate descent on the dual."""
    sign = np.where(good, 1.0, -1.0)
    weights = np.zeros(x.shape[1] + 1, np.float64)
    alpha = np.zeros(len(x))
    squared = (x.astype(np.float64) ** 2).sum(axis=1) + 1 + 1 / (2 * cost)
    order = np.random.RandomState(0)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(x)).tolist():
            gradient = sign[i] * (x[i] @ weights[:-1] + weights[-1]) - 1 + alpha[i] / (2 * cost)
            step = max(alpha[i] - gradient / squared[i], 0.0) - alpha[i]
            if step:
                alpha[i] += step
                weights[:-1] += (step * sign[i]) * x[i]
                weights[-1] += step * sign[i]
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights


@dataclass(frozen=True)
class Model:
    """Families (their languages in order), a machine per family, and per family one for
    each two languages (numbers of the two, the first being the positive side)."""

    families: tuple[tuple[str, ...], ...]
    of_family: np.ndarray
    pairs: tuple[tuple[tuple[int, int, np.ndarray], ...], ...]

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score of each vector."""
        names = np.full(len(x), UNDETERMINED, object)
        scores = np.zeros(len(x))
        if not self.families:
            return names, scores
        family, sure = self._family(x)
        for number, languages in enumerate(self.families):
            rows = np.flatnonzero(family == number)
            if not len(rows):
                continue
            winner, share = self._within(number, x[rows])
            names[rows] = np.array(languages, object)[winner]
            scores[rows] = sure[rows] * share
        return names, scores

    def _family(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(self.families) == 1:
            return np.zeros(len(x), np.int64), np.ones(len(x))
        margins = margin(x, self.of_family)
        family = margins.argmax(axis=1)
        power = np.exp(2 * (margins - margins.max(axis=1, keepdims=True)))
        return family, 1 / power.sum(axis=1)

    def _within(self, number: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count = len(self.families[number])
        votes, sums, chance = (np.zeros((len(x), count)) for _ in range(3))
        for one, two, weights in self.pairs[number]:
            apart = margin(x, weights[:, None])[:, 0]
            votes[:, one] += apart >= 0
            votes[:, two] += apart < 0
            sums[:, one] += apart
            sums[:, two] -= apart
            likely = 1 / (1 + np.exp(-2 * np.clip(apart, -50, 50)))
            chance[:, one] += likely
            chance[:, two] += 1 - likely
        best = votes == votes.max(axis=1, keepdims=True)
        winner = np.where(best, sums, -np.inf).argmax(axis=1)
        if count == 1:
            return winner, np.ones(len(x))
        return winner, chance[np.arange(len(x)), winner] / (count - 1)


def margin(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """A column per machine (columns of weights)."""
    return x.astype(np.float64) @ weights[:-1] + weights[-1]


def fit(x: np.ndarray, languages: np.ndarray, families: dict[str, tuple[str, ...]] = FAMILIES) -> Model:
    """The machines for vectors and their languages."""
    known = sorted(set(languages.tolist()))
    listed = {language: family for family, members in families.items() for language in members}
    groups: dict[tuple[int, str], list[str]] = {}
    for language in known:
        name = (0, listed[language]) if language in listed else (1, language)
        groups.setdefault(name, []).append(language)
    members = tuple(tuple(groups[g]) for g in sorted(groups))
    of_family = np.zeros((x.shape[1] + 1, len(members)))
    if len(members) > 1:
        for number, group in enumerate(members):
            of_family[:, number] = machine(x, np.isin(languages, group))
    pairs = []
    for group in members:
        own = []
        for a in range(len(group)):
            for b in range(a + 1, len(group)):
                rows = (languages == group[a]) | (languages == group[b])
                own.append((a, b, machine(x[rows], languages[rows] == group[a])))
        pairs.append(tuple(own))
    return Model(members, of_family, tuple(pairs))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, text) to (lang, numbers and values of the entries that are not 0)."""
    for batch in batches:
        rows = [x for part in profiles(batch["text"]) for x in part]
        places = [np.flatnonzero(x) for x in rows]
        yield pa.RecordBatch.from_arrays(
            [
                batch["lang"],
                pa.array([p.astype("<u4").tobytes() for p in places], pa.binary()),
                pa.array([x[p].astype("<f4").tobytes() for x, p in zip(rows, places, strict=True)], pa.binary()),
            ],
            ["lang", "places", "values"],
        )


def train(
    docs: DataFrame, learn: Column, sample: int = SAMPLE, families: dict[str, tuple[str, ...]] = FAMILIES
) -> Model:
    """A model from the documents (doc_id, text, lang) for which ``learn`` holds."""
    rows = pick(docs, "doc_id", "text", "lang").where(learn)
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & has_letter(F.col("text")))
    size = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not size:
        return Model((), np.zeros((BUCKETS + 1, 0)), ())
    each = max(1, sample // len(size))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)
    share = F.lit(0.0)
    for language, count in size.items():
        share = F.when(F.col("lang") == language, min(1.0, each / count)).otherwise(share)
    chosen = rows.where(place < share).select("lang", "text")
    found = chosen.mapInArrow(_sparse, "lang string, places binary, values binary").collect()
    found.sort(key=lambda r: (r["lang"], r["places"], r["values"]))
    x = np.zeros((len(found), BUCKETS), np.float32)
    for row, r in enumerate(found):
        x[row, np.frombuffer(r["places"], "<u4")] = np.frombuffer(r["values"], "<f4")
    return fit(x, np.array([r["lang"] for r in found], object), families)


def identified(model):
    """The column function for language and score under a broadcast model."""

    def identify(texts: pa.Array) -> pa.Array:
        found = [model.value.predict(x) for x in profiles(texts)]
        names = np.concatenate([np.zeros(0, object), *(n for n, _ in found)])
        scores = np.concatenate([np.zeros(0), *(s for _, s in found)])
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"]
        )

    return arrow_udf(identify, "struct<lang_pred:string,score:double>")


def identify_languages(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score."""
    rows, names = enclose(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = inner(names, "text")
    found = rows.withColumn("_found", identified(shared)(text)).withColumn("_known", has_letter(F.col(text)))
    return disclose(
        found.withColumns(
            {
                "lang_pred": F.when(F.col("_known"), F.col("_found.lang_pred")).otherwise(UNDETERMINED),
                "score": F.when(F.col("_known"), F.col("_found.score")).otherwise(0.0),
            }
        ),
        names,
        "lang_pred",
        "score",
    )


def held_out(column: str = "doc_id") -> Column:
    """Documents that no model may learn from; one without id is none of them."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 4 == 2, F.lit(False))
