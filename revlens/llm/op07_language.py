"""Language identification: family first, then one-versus-one linear support vector machines.

A text is the row of its letters (lower case; every other character counts as one gap), seen
as hashed byte pairs and triples: square roots of their shares, `FEATURES` places. A softmax
over families decides the family; within it, a linear support vector machine for every pair of
languages votes. Both are fitted on a bounded sample, the `PER_LANGUAGE` rows with the smallest
text hash of each language among rows whose crc32(doc_id as text) mod 4 is not 2, fewer where there
are so many languages that more than `SAMPLE` rows would come together (they reach the driver as
sparse rows). Prediction reads whole texts and nothing else.

Defined results: one row per input row; `und` with score 0 for a null text or one without a
letter, and for all rows if nothing could be learned; a null doc_id is not held out and not
learned from; rows repeat as they come; extra columns are ignored. A language that the family
table doesn't name is a family of its own. Ties go to the language first in the alphabet.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.llm import arrowtext

FEATURES = 1 << 12
PER_LANGUAGE = 400
SAMPLE = 10_000
PLACE = np.dtype([("at", "<u2"), ("value", "<f4")])

#: Language codes of each family.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "nb", "nl", "nn", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "uralic": ("et", "fi", "hu"),
    "celtic": ("br", "cy", "ga", "gd"),
    "turkic": ("az", "kk", "ky", "tr", "uz"),
    "semitic": ("ar", "he", "mt"),
    "indo-aryan": ("bn", "gu", "hi", "mr", "ne", "pa", "si", "ur"),
    "dravidian": ("kn", "ml", "ta", "te"),
    "iranian": ("fa", "ku", "ps"),
    "austronesian": ("id", "jv", "ms", "tl"),
    "sinitic": ("yue", "zh"),
}

LETTERS = arrowtext.byte_class(b"abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)))


def family_of(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang in langs), lang)


def profiles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Unit feature rows of the texts, and which texts have a letter."""
    n = len(texts)
    data, offsets = arrowtext.text_bytes(texts, lower=True)
    text = np.repeat(np.arange(n), np.diff(offsets))
    letter = LETTERS[data]
    used = letter.copy()
    used[1:] |= letter[:-1]  # the first of a run of other characters stands for the gap
    value, text = np.where(letter, data, 32)[used].astype(np.uint32), text[used]
    out = np.zeros((n, FEATURES), np.float32)
    mask = np.uint32(FEATURES // 2 - 1)
    flat = out.reshape(-1)
    for width, multiplier, at in ((2, 40503, 0), (3, 2654435761, FEATURES // 2)):
        if len(value) < width:
            continue
        m = len(value) - width + 1
        gram = value[:m].copy()
        for k in range(1, width):
            gram = gram * np.uint32(257) + value[k : m + k]
        gram = (gram * np.uint32(multiplier) >> np.uint32(15)) & mask
        inside = text[:m] == text[width - 1 :]
        flat += np.bincount(text[:m][inside] * FEATURES + gram[inside] + at, minlength=n * FEATURES).astype(np.float32)
    total = np.maximum(out.sum(1, keepdims=True), 1)
    has = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
    return np.sqrt(out / total), has


def softmax_fit(x: np.ndarray, y: np.ndarray, classes: int, rounds: int = 150, rate: float = 0.5) -> np.ndarray:
    w, sums, truth = np.zeros((x.shape[1], classes)), np.full((x.shape[1], classes), 1e-8), np.eye(classes)[y]
    share = (1 / np.maximum(np.bincount(y, minlength=classes), 1))[y][:, None] / classes
    for _ in range(rounds):
        z = x @ w
        p = np.exp(z - z.max(1, keepdims=True))
        g = x.T @ ((p / p.sum(1, keepdims=True) - truth) * share) + 1e-5 * w
        sums += g * g
        w -= rate * g / np.sqrt(sums)
    return w


def svm_fit(x: np.ndarray, sign: np.ndarray, rounds: int = 150, rate: float = 0.5) -> np.ndarray:
    """Squared hinge loss, both classes of equal weight."""
    w, sums = np.zeros(x.shape[1]), np.full(x.shape[1], 1e-8)
    share = np.where(sign > 0, 0.5 / max(1, (sign > 0).sum()), 0.5 / max(1, (sign < 0).sum()))
    for _ in range(rounds):
        slack = np.maximum(0, 1 - sign * (x @ w))
        g = -2 * x.T @ (sign * slack * share) + 1e-5 * w
        sums += g * g
        w -= rate * g / np.sqrt(sums)
    return w


def fit(x: np.ndarray, langs: list[str]) -> dict:
    """The model: families, their softmax, and one machine for each pair of languages of a family."""
    names = sorted(set(langs))
    families = sorted({family_of(x) for x in names})
    lang = np.array([names.index(v) for v in langs])
    family = np.array([families.index(family_of(v)) for v in names])
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    pairs = [(a, b) for a, b in combinations(range(len(names)), 2) if family[a] == family[b]]
    machines = []
    for a, b in pairs:
        rows = (lang == a) | (lang == b)
        machines.append(svm_fit(x[rows], np.where(lang[rows] == a, 1.0, -1.0)))
    top = softmax_fit(x, family[lang], len(families)) if len(families) > 1 else np.zeros((x.shape[1], 1))
    return {"names": names, "family": family, "softmax": top.astype(np.float32), "pairs": pairs, "machines": np.array(machines, np.float32).reshape(len(pairs), x.shape[1])}


def predict(model: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the language and a score from 0 to 1 for every row."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    z = x @ model["softmax"]
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    family = p.argmax(1)
    votes = np.where(model["family"][None, :] == family[:, None], 0.0, -np.inf)
    belief = np.ones(votes.shape)
    margin = x @ model["machines"].T
    for k, (a, b) in enumerate(model["pairs"]):
        votes[:, a] += margin[:, k] >= 0
        votes[:, b] += margin[:, k] < 0
        sure = 1 / (1 + np.exp(-2 * margin[:, k]))
        belief[:, a] *= sure
        belief[:, b] *= 1 - sure
    best = votes.argmax(1)
    belief *= model["family"][None, :] == family[:, None]
    rows = np.arange(len(x))
    return best, p[rows, family] * belief[rows, best] / np.maximum(belief.sum(1), 1e-300)


def packed(x: np.ndarray) -> list[bytes]:
    """Places and values of each row that aren't zero."""
    out = []
    for row in x:
        at = np.flatnonzero(row)
        places = np.empty(len(at), PLACE)
        places["at"], places["value"] = at, row[at]
        out.append(places.tobytes())
    return out


def unpacked(rows: list[bytes]) -> np.ndarray:
    x = np.zeros((len(rows), FEATURES), np.float32)
    for k, data in enumerate(rows):
        places = np.frombuffer(data, PLACE)
        x[k, places["at"]] = places["value"]
    return x


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, sample: int = SAMPLE) -> dict | None:
    """The model; of rows that share an id and language the first in byte order of their features is learned from."""
    learn = docs.select("doc_id", "lang", "text").where("lang IS NOT NULL AND text IS NOT NULL AND crc32(cast(doc_id AS string)) % 4 <> 2")
    thin = learn.select("doc_id", "lang", F.xxhash64("text").alias("h"))
    per_language = max(1, min(per_language, sample // max(1, learn.select("lang").distinct().count())))
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    chosen = thin.withColumn("k", F.row_number().over(order)).where(F.col("k") <= per_language).select("doc_id", F.col("lang").alias("lang_learned"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrowtext.slices(batch, "text"):
                x, has = profiles(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("lang"), pa.array(has), pa.array(packed(x), pa.binary())], ["doc_id", "lang", "has", "x"])

    # bounded: per_language rows of each language
    texts = learn.join(F.broadcast(chosen), (F.col("lang") == F.col("lang_learned")) & learn["doc_id"].eqNullSafe(chosen["doc_id"]), "left_semi")
    rows = texts.select(F.col("doc_id").cast("long"), "lang", "text").mapInArrow(task, "doc_id long, lang string, has boolean, x binary").where("has").groupBy("doc_id", "lang").agg(F.min("x").alias("x")).collect()
    rows.sort(key=lambda r: (r["lang"], r["doc_id"]))
    if not rows:
        return None
    return fit(unpacked([r["x"] for r in rows]), [r["lang"] for r in rows])


def identify(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        for batch in batches:
            for part in arrowtext.slices(batch, "text", arrowtext.CHUNK_BYTES // 2):
                for low in range(0, part.num_rows, 500):
                    rows = part.slice(low, 500)
                    x, has = profiles(rows.column("text"))
                    if model is None:
                        names, score = np.full(len(x), "und", object), np.zeros(len(x))
                    else:
                        best, score = predict(model, x)
                        names, score = np.where(has, np.array(model["names"], object)[best], "und"), np.where(has, score, 0.0)
                    yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("held_out"), pa.array(names, pa.string()), pa.array(score.astype(np.float64))], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.expr("coalesce(crc32(cast(doc_id AS string)) % 4 = 2, false)").alias("held_out"), "text")
    return rows.mapInArrow(task, "doc_id long, held_out boolean, lang_pred string, score double")


def op7_hierarchical_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(docs, train(docs))
