"""Language identification in two steps: the family first, then one-versus-one linear SVMs within it.

Texts become counts of byte trigrams of lower-cased letters (anything else is a space), hashed, as shares of the text.
A linear SVM per family tells it from all others; within a family one SVM per pair of its languages votes. Families
come from a table of language codes; codes it does not name are families of their own.

Training reads at most ``PER_LANGUAGE`` documents of each language (least hash of the id), whole texts, by descent in a
fixed order in one task. The model has one column of ``2 ** BITS`` weights per classifier. Prediction is a sum of
weights per text, in Arrow batches, without a shuffle.

Defined cases: ``und`` with score 0 if the text is null or has no letter, or nothing could be learned; texts without
a known trigram fall to the largest bias; of equally likely families the first by name is taken, of equal votes within it
the first language by code, and a pair whose margin is 0 votes for the later of its two; documents without a language are not learned from; repeated rows get the same
answer; an empty table gives no rows; further columns stay, except that ``lang_pred`` and ``score`` are replaced.
"""

from __future__ import annotations

import io
import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from tidegrid.llm.quality import _order, sigmoid, thin
from tidegrid.llm.words import slices, text_bytes

BITS = 15
PER_LANGUAGE = 1000
#: Ids of the sample are shipped to all tasks up to this many (a thousand languages).
BROADCAST_IDS = 1_000_000
SCALE = 20.0

# ISO 639-1 codes by language family.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "turkic": "az kk tr uz",
    "semitic": "am ar he mt",
    "indo-aryan": "bn gu hi mr ne pa ur",
    "iranian": "fa ku ps",
    "dravidian": "kn ml ta te",
    "malayic": "id ms",
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_LETTER = np.arange(256, dtype=np.uint8)
_LETTER[:128] = 32
_LETTER[97:123] = np.arange(97, 123)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def trigrams(column: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Bins of all trigrams of letters, text by text, and the text of each."""
    column = pc.utf8_lower(pc.fill_null(column, ""))
    padded = pc.binary_join_element_wise(pa.scalar(" "), column, pa.scalar(" "), pa.scalar(""))
    data, offsets = text_bytes(padded)
    data = _LETTER[data].astype(np.uint32)
    code = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
    owner = np.repeat(np.arange(len(column)), np.diff(offsets))
    inside = (owner[:-2] == owner[2:]) & (code != 0x202020)
    bins = (code[inside] * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)
    return bins.astype(np.int64), owner[:-2][inside]


class Model:
    """Families, languages and their classifiers: ``weights`` has a column per classifier, the last row is the bias."""

    def __init__(self, languages: list[str], weights: np.ndarray):
        self.languages, self.weights = languages, weights
        self.of = [FAMILY.get(c, c) for c in languages]
        self.families = sorted(set(self.of))
        self.pairs = [(i, j) for i, j in itertools.combinations(range(len(languages)), 2) if self.of[i] == self.of[j]]
        self.n = len(self.families) + len(self.pairs)

    def predict(self, margins: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score from the margins of all classifiers (texts x classifiers)."""
        n_families = len(self.families)
        likely = sigmoid(2 * margins[:, :n_families])
        family = likely.argmax(axis=1)
        share = likely.max(axis=1) / likely.sum(axis=1) if n_families > 1 else np.ones(len(margins))
        votes = np.full((len(margins), len(self.languages)), -np.inf)
        for i, name in enumerate(self.of):
            votes[family == self.families.index(name), i] = 0
        belief, met = np.zeros_like(votes), np.zeros(len(self.languages))
        for k, (i, j) in enumerate(self.pairs):
            m = margins[:, n_families + k]
            p = sigmoid(2 * m)
            votes[:, i] += (m > 0) + 1e-6 * p
            votes[:, j] += (m <= 0) + 1e-6 * (1 - p)
            belief[:, i] += p
            belief[:, j] += 1 - p
            met[[i, j]] += 1
        best = votes.argmax(axis=1)
        within = np.where(met[best] > 0, belief[np.arange(len(best)), best] / np.maximum(met[best], 1), 1.0)
        return [self.languages[i] for i in best], share * within


def fit_svm(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, size: int, rounds: int = 12, c: float = 1.0) -> np.ndarray:
    """Linear SVM by dual coordinate descent over sparse rows (bins, values); the last weight is the bias."""
    w, dual = np.zeros(size + 1), np.zeros(len(rows))
    norms = np.array([v @ v + 1.0 for _, v in rows])
    # A class with fewer rows weighs as much as the other.
    upper = np.where(labels > 0, (labels <= 0).sum(), (labels > 0).sum()) * c / max(1, len(labels))
    order = np.random.default_rng(0).permutation(len(rows))
    for _ in range(rounds):
        for i in order:
            bins, values = rows[i]
            gradient = labels[i] * (w[bins] @ values + w[-1]) - 1
            new = min(max(dual[i] - gradient / norms[i], 0.0), upper[i])
            step = (new - dual[i]) * labels[i]
            if step:
                dual[i] = new
                w[bins] += step * values
                w[-1] += step
    return w


def language_sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """At most ``per_language`` rows ``doc_id, lang, text`` of each language, those with the least hash of the id."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "lang")
    counts = known.groupBy("lang").agg(F.count("*").alias("_n"))
    counts = F.broadcast(counts) if counts.count() <= BROADCAST_IDS else counts
    # Twice the share that is needed, by hash; only those are ranked.
    likely = thin(F.col("doc_id"), 2 * per_language, F.col("_n"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = known.join(counts, "lang").filter(likely).withColumn("_r", F.row_number().over(order)).filter(
        F.col("_r") <= per_language
    ).select("doc_id", "lang").distinct()
    n = ids.count()
    ids = F.broadcast(ids) if n <= BROADCAST_IDS else ids
    return docs.select("doc_id", "lang", "text").join(ids, ["doc_id", "lang"]).filter(has_letter(F.col("text"))).groupBy(
        "doc_id", "lang"
    ).agg(F.max("text").alias("text"))


def train(sample: DataFrame, bits: int = BITS) -> Model | None:
    """The model from rows ``doc_id, lang, text``; None if there are none."""

    def vectors(batches):
        for batch in batches:
            for piece in slices(batch):
                bins, owner = trigrams(piece.column("text"), bits)
                key, count = np.unique(owner << bits | bins, return_counts=True)
                begin = np.searchsorted(key >> bits, np.arange(piece.num_rows + 1))
                bodies = [((key[a:b] & (1 << bits) - 1).astype(np.int32).tobytes(), count[a:b].astype(np.int32).tobytes())
                          for a, b in itertools.pairwise(begin.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("lang"), pa.array([b[0] for b in bodies], pa.binary()),
                     pa.array([b[1] for b in bodies], pa.binary())], names=["doc_id", "lang", "bins", "counts"],
                )

    def fit(batches):
        rows, langs = [], []
        for r in sorted((r for batch in batches for r in batch.to_pylist()), key=lambda r: (_order(r), r["lang"])):
            counts = np.frombuffer(r["counts"], np.int32).astype(np.float64)
            if len(counts):
                rows.append((np.frombuffer(r["bins"], np.int32), SCALE * counts / counts.sum()))
                langs.append(r["lang"])
        if not rows:
            return
        model = Model(sorted(set(langs)), np.zeros(0))
        at = np.array([model.languages.index(c) for c in langs])
        family = np.array([model.families.index(FAMILY.get(c, c)) for c in langs])
        columns = [
            fit_svm(rows, np.where(family == f, 1.0, -1.0), 1 << bits) if len(model.families) > 1 else np.zeros((1 << bits) + 1)
            for f in range(len(model.families))
        ]
        for i, j in model.pairs:
            own = np.flatnonzero((at == i) | (at == j))
            columns.append(fit_svm([rows[k] for k in own], np.where(at[own] == i, 1.0, -1.0), 1 << bits))
        out = io.BytesIO()
        np.savez_compressed(out, languages=np.array(model.languages), weights=np.stack(columns, axis=1).astype(np.float32))
        yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], names=["model"])

    vecs = sample.mapInArrow(vectors, "doc_id long, lang string, bins binary, counts binary")
    found = vecs.repartition(1).mapInArrow(fit, "model binary").first()
    if found is None:
        return None
    got = np.load(io.BytesIO(bytes(found["model"])))
    return Model(got["languages"].tolist(), got["weights"])


def identify(docs: DataFrame, model: Model | None, bits: int = BITS, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1)."""
    docs = docs.drop("lang_pred", "score")
    names = docs.columns
    if model is None:
        return docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    flag = "_has_letter"
    while flag in names:
        flag += "_"

    def run(batches):
        for batch in batches:
            for piece in slices(batch, text):
                bins, owner = trigrams(piece.column(text), bits)
                n = piece.num_rows
                total = np.maximum(np.bincount(owner, minlength=n), 1)
                margins = np.stack(
                    [np.bincount(owner, w[bins], minlength=n) * SCALE / total + w[-1] for w in model.weights.T], axis=1
                )
                found, score = model.predict(margins)
                real = piece.column(flag).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(c) for c in names), pa.array([f if r else "und" for f, r in zip(found, real)], pa.string()),
                     pa.array(np.where(np.array(real), score, 0.0))], names=[*names, "lang_pred", "score"],
                )

    return docs.withColumn(flag, has_letter(F.col(text))).mapInArrow(run, schema)
