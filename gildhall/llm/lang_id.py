"""Language identification by a blended-spectrum string kernel.

``k(x, y)`` counts the byte n-grams (one to four bytes, lower case, everything
in ASCII that is no letter read as a space) present in both texts, over
hashed buckets, divided by the square root of the product of their numbers.
Landmark texts span a Nyström subspace; one-versus-rest kernel ridge
regression is fitted in it. Because the kernel is an inner product of presence
vectors, the landmark block and the ridge weights fold into one matrix, and a
batch of texts is scored by one matrix product.

The fit uses a bounded sample of labelled rows; what reaches the driver is a
bit vector of ``BUCKETS / 8`` bytes a row, whatever the length of the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gildhall.llm._util import id_text, map_arrow, share

BUCKETS = 1 << 14
ORDERS = (1, 2, 3, 4)
#: Documented bounds of the fit: labelled rows for each language, landmarks over all languages.
PER_LANG = 400
SAMPLE_ROWS = 20_000  # of all languages together, 2 KB each on the driver
LANDMARKS = 256
SLICES = 16
RIDGE = 1e-3
UNDETERMINED = "und"
#: Distinct n-grams from which on a text's best output says whether it is in any of the languages at all. Noise of letters
#: is refused up to ``SHARE`` of the way from its own best output to the lowest one of labelled texts.
EVIDENCE, SHARE = 1000, 0.15

ROWS_PER_BLOCK = 64
STRIDE = 1 << 19
LETTER = regex.compile(r"\p{L}")


def _byte_classes() -> np.ndarray:
    keep = np.arange(256, dtype=np.uint8)
    ascii_range = np.arange(128)
    letters = ((ascii_range | 32) >= ord("a")) & ((ascii_range | 32) <= ord("z"))
    keep[:128] = np.where(letters, ascii_range | 32, 32)
    return keep


BYTE_CLASS = _byte_classes()


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """0/1 matrix (texts × buckets) of the n-grams in each text.

    ``data[offsets[i]:offsets[i + 1]]`` are the bytes of text ``i``. Works
    through the bytes in strides that overlap by three, so memory does not
    follow the length of a text.
    """
    n = len(offsets) - 1
    out = np.zeros((n, BUCKETS), dtype=np.float32)
    flat = out.ravel()
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    last = max(ORDERS) - 1
    for at in range(int(offsets[0]), int(offsets[-1]), STRIDE):
        to = min(at + STRIDE + last, int(offsets[-1]))
        code = BYTE_CLASS[data[at:to]].astype(np.uint32)
        base = np.repeat(np.arange(n, dtype=np.int32), np.diff(np.clip(offsets - at, 0, to - at)))
        gram = code
        for order in ORDERS:
            if order > 1:
                if len(code) < order:
                    break
                gram = gram[:-1] | (code[order - 1:] << np.uint32(8 * (order - 1)))
            slot = ((gram + np.uint32(0x9E37 * order)) * np.uint32(0x9E3779B1)) >> shift
            row = base[:len(slot)]
            inside = row == base[order - 1:]
            flat[row[inside].astype(np.int64) * BUCKETS + slot[inside]] = 1
    return out


def _blocks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """Presence matrices of up to ``ROWS_PER_BLOCK`` rows at a time."""
    low = pc.utf8_lower(texts).cast(pa.large_string())
    offsets = np.frombuffer(low.buffers()[1], dtype=np.int64)[low.offset:low.offset + len(low) + 1]
    raw = low.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    for i in range(0, len(low), ROWS_PER_BLOCK):
        j = min(i + ROWS_PER_BLOCK, len(low))
        yield i, j, presence(data, offsets[i:j + 1])


def _unit(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.sqrt(np.maximum(matrix.sum(axis=1, keepdims=True), 1))


@dataclass
class LangModel:
    langs: list[str]
    weights: np.ndarray  # buckets × languages
    #: Best output under which a text of at least ``EVIDENCE`` n-grams is in none of the languages.
    floor: float = -np.inf

    def scores(self, matrix: np.ndarray) -> np.ndarray:
        """Ridge outputs (texts × languages), +1 for the language and -1 for the rest."""
        return _unit(matrix) @ self.weights


def _sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, learn: Column) -> list:
    """Presence bits of at most ``PER_LANG`` labelled rows of each language (``SAMPLE_ROWS`` of all), by hash of the id.

    The rows are picked from the two narrow columns; their texts are then
    turned into bits where they lie.
    """
    def first(*keys: str) -> Column:
        return F.row_number().over(Window.partitionBy(*keys).orderBy("h", "doc_id"))

    picked = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).alias("lang"), learn.alias("learn"))
              .where("learn AND lang IS NOT NULL AND doc_id IS NOT NULL")
              .select("doc_id", "lang", F.xxhash64(F.lit("lang"), "doc_id").alias("h"))
              .dropDuplicates(["doc_id"])
              # a language that most rows have is thinned in slices first
              .withColumn("slice", F.pmod("h", F.lit(SLICES)))
              .withColumn("rn", first("lang", "slice")).where(F.col("rn") <= PER_LANG)
              .withColumn("rn", first("lang")).where(F.col("rn") <= PER_LANG)
              .select("doc_id", "lang", "rn"))
    # with very many languages fewer rows of each: every one's first row, then every one's second, ...
    picked = picked.orderBy("rn", "lang").limit(SAMPLE_ROWS)
    texts = id_text(docs, id_col, text_col)

    def bits(batches):
        for b in batches:
            low = b.column("text")
            for i, j, m in _blocks(low):
                part = b.slice(i, j - i)
                packed = [r.tobytes() if r.any() else None for r in np.packbits(m.astype(bool), axis=1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang"), part.column("rn"), pa.array(packed, pa.binary())], ["lang", "rn", "bits"])

    # the picked rows are bounded by PER_LANG a language, so this side may be broadcast
    sample = texts.join(F.broadcast(picked), "doc_id").select("lang", "rn", "text")
    return map_arrow(sample, bits, "lang string, rn int, bits binary").where("bits IS NOT NULL").collect()


def fit(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LangModel:
    """Nyström landmarks and one-versus-rest ridge weights from the labelled rows where ``learn`` holds."""
    rows = sorted(_sample(docs, id_col, text_col, lang_col, learn), key=lambda r: (r["rn"], r["lang"]))
    langs = sorted({r["lang"] for r in rows})
    if not rows:
        return LangModel([], np.zeros((BUCKETS, 0), dtype=np.float32))

    model = _solved(rows, langs)
    model.floor = _floor(rows, langs)
    return model


def _matrix(rows: list) -> np.ndarray:
    packed = np.frombuffer(b"".join(r["bits"] for r in rows), dtype=np.uint8).reshape(len(rows), -1)
    return np.unpackbits(packed, axis=1).astype(np.float32)


def _slices(rows: list) -> Iterator[list]:
    """Rows whose dense form is held at a time."""
    return (rows[i:i + 512] for i in range(0, len(rows), 512))


def _solved(rows: list, langs: list[str]) -> LangModel:
    landmarks = _unit(_matrix(rows[:max(LANDMARKS, len(langs))]))
    k_mm = (landmarks @ landmarks.T).astype(np.float64)
    lhs = RIDGE * len(rows) * k_mm + 1e-6 * len(rows) * np.eye(len(landmarks))
    rhs = np.zeros((len(landmarks), len(langs)))
    for some in _slices(rows):
        k_nm = (_unit(_matrix(some)) @ landmarks.T).astype(np.float64)
        y = np.where(np.array([r["lang"] for r in some])[:, None] == np.array(langs)[None, :], 1.0, -1.0)
        lhs += k_nm.T @ k_nm
        rhs += k_nm.T @ y
    return LangModel(langs, (landmarks.T @ np.linalg.solve(lhs, rhs)).astype(np.float32))


def _floor(rows: list, langs: list[str]) -> float:
    """Between noise of letters and labelled rows that a model of the other three quarters has not seen.

    Minus infinity (nothing is refused) where too few rows have the evidence,
    or some of them look no better than noise.
    """
    seen, unseen = ([r for r in rows if (r["rn"] % 4 == 0) == out] for out in (False, True))
    if not seen or not unseen:
        return -np.inf
    model = _solved(seen, langs)
    best = [model.scores(m).max(axis=1)[m.sum(axis=1) >= EVIDENCE] for m in map(_matrix, _slices(unseen))]
    low = min((float(b.min()) for b in best if len(b)), default=-np.inf)
    rng = np.random.default_rng(7)
    letters = rng.integers(ord("a"), ord("z") + 1, (64, 4000)).astype(np.uint8)
    letters[rng.random(letters.shape) < 0.15] = ord(" ")
    noise = float(model.scores(presence(letters.ravel(), np.arange(65) * letters.shape[1])).max())
    return noise + SHARE * (low - noise) if low > noise else -np.inf


def _judge(model: LangModel, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Index of the language (past the last: undetermined) and score of each text."""
    pred = np.full(len(texts), len(model.langs))
    conf = np.zeros(len(texts))
    if model.langs:
        for i, j, grams in _blocks(texts):
            f = np.clip((model.scores(grams) + 1) / 2, 0, 1).astype(np.float64) + 1e-9
            pred[i:j] = f.argmax(axis=1)
            conf[i:j] = f.max(axis=1) / f.sum(axis=1)
        for i, t in enumerate(texts):
            if not LETTER.search(t.as_py()):
                pred[i], conf[i] = len(model.langs), 0.0
    return pred, conf


def predict(docs: DataFrame, model: LangModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (0 to 1) for every row of ``docs``.

    A text that is null or has no letter is ``und`` with score 0, as is every
    text when nothing could be learned. Ties go to the language that sorts
    first. Reads nothing but the text; other columns are ignored. Rows with a
    null id and repeated rows are scored like any other.
    """
    shared = share(docs.sparkSession, model)

    def score(batches):
        names = np.array([*shared.value.langs, UNDETERMINED], dtype=object)
        for b in batches:
            pred, conf = _judge(shared.value, b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(names[pred], pa.string()), pa.array(conf)], ["doc_id", "lang_pred", "score"])

    return map_arrow(id_text(docs, id_col, text_col), score, "doc_id long, lang_pred string, score double")


def accepted(docs: DataFrame, model: LangModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that are in one of the model's languages.

    Texts without a letter go, and texts of at least ``EVIDENCE`` distinct n-grams
    whose best output lies below the model's floor: those resemble none of
    the languages as far as any learned text does. Shorter texts say too little
    and stay. Repeated rows are judged alike; an empty table stays empty. A
    filter within the scan's own partitions: nothing is shuffled.
    """
    shared = share(docs.sparkSession, model)

    def keep(batches):
        m = shared.value
        for b in batches:
            texts = pc.fill_null(b.column(b.schema.get_field_index(text_col)), "")
            good = np.zeros(len(texts), dtype=bool)
            for i, j, grams in _blocks(texts) if m.langs else ():
                good[i:j] = (grams.sum(axis=1) < EVIDENCE) | (m.scores(grams).max(axis=1) >= m.floor)
            good &= np.array([bool(LETTER.search(t.as_py())) for t in texts], dtype=bool)
            yield b.filter(pa.array(good))

    return map_arrow(docs, keep, docs.schema)
