"""Language identification with Bloom filters whose slots are bit masks over the languages.

Character trigrams around every letter are counted per language over all learning documents. A
language's filter holds all its trigrams that are not much rarer there than elsewhere.
All filters share one table of slots; bit l of a slot belongs to language l, so one lookup
(the AND of a trigram's slots) gives all languages that contain it. Languages beyond a mask's 64 bits
get further tables. Executors OR the masks of every slot; only finished slots reach the driver. Their
number follows from the largest filter up to a bound in bytes; past it more trigrams share a
slot, and the rate of false positives that the hits are corrected for rises. A document's corrected
hits per language decide.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import per_worker, pick, remainder

UNDETERMINED = "und"
#: Of the model: least bits of the slot number, least slots per trigram of the largest filter, slots that a
#: trigram marks.
SLOT_BITS = 20
SLOTS_PER_GRAM = 20
HASHES = 3
#: The tables of all languages together take at most about this many bytes; no language or trigram is left out
#: for it.
TABLE_BYTES = 64 << 20
#: Slots that the driver receives as one row.
SLOTS_PER_ROW = 1 << 14
#: A trigram belongs to a language if its rate there is at least this part of its highest rate.
RATE_SHARE = 0.5
#: Characters handled at a time (a worker takes about 130 bytes for each), and distinct trigrams that a learning
#: task holds.
AT_ONCE = 1 << 17
HELD_GRAMS = 1 << 20

#: Odd multipliers for mixing.
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: whether it is a letter; its lower-case code point."""
    points = range(0x110000)
    # From iterators: lists of all characters would cost a worker over 100 MB.
    letter = np.fromiter((chr(c).isalpha() for c in points), bool, len(points))
    lower = np.fromiter((ord(x) if len(x := chr(c).lower()) == 1 else c for c in points), np.int64, len(points))
    return letter, lower


def _pieces(texts: list[str | None]):
    """Lists of (row, piece); a piece has one more character at both ends, and lists are short."""
    held, size = [], 0
    for row, text in enumerate(texts):
        for s in range(0, len(text or ""), AT_ONCE):
            piece = (text[s - 1] if s else " ") + text[s:s + AT_ONCE] + (text[s + AT_ONCE:s + AT_ONCE + 1] or " ")
            held.append((row, piece))
            size += len(piece)
            if size >= AT_ONCE:
                yield held
                held, size = [], 0
    if held:
        yield held


def trigrams(texts: list[str | None]):
    """(row, trigram) arrays: lower-cased trigrams whose middle is a letter; other characters count
    as blanks. All of each text, in bounded portions."""
    letter, lower = per_worker(("letters",), _tables)
    for held in _pieces(texts):
        codes = np.frombuffer("".join(p for _, p in held).encode("utf-32-le", "surrogatepass"), "<u4")
        sizes = np.array([len(p) for _, p in held])
        rows = np.repeat(np.array([r for r, _ in held]), sizes)
        is_letter = letter[codes]
        chars = np.where(is_letter, lower[codes], 32)
        inner = is_letter.copy()
        ends = np.cumsum(sizes)
        inner[ends - 1] = False
        inner[ends - sizes] = False
        at = np.flatnonzero(inner)
        yield rows[at], (chars[at - 1] << 42) | (chars[at] << 21) | chars[at + 1]


def slots_of(grams: np.ndarray, slot_bits: int = SLOT_BITS, hashes: int = HASHES):
    """The slot numbers of the grams, one array per hash."""
    x = grams.astype(np.uint64)
    for k in range(hashes):
        y = (x ^ (x >> np.uint64(29))) * MIX[k % len(MIX)] + np.uint64(k)
        yield ((y ^ (y >> np.uint64(32))) * MIX[(k + 1) % len(MIX)]) >> np.uint64(64 - slot_bits)


@dataclass
class Model:
    """``words[w][slot]`` has a bit for each language from 64 * w on."""

    languages: list[str]
    fallback: str
    words: list[np.ndarray]
    slot_bits: int = SLOT_BITS
    hashes: int = HASHES

    def __post_init__(self):
        fill = [np.mean(self._bit(self.words[i // 64], i)) for i in range(len(self.languages))]
        self.false_rate = np.minimum(np.array(fill, float) ** self.hashes, 0.999)

    @staticmethod
    def _bit(masks: np.ndarray, language: int) -> np.ndarray:
        return (masks >> masks.dtype.type(language % 64)) & masks.dtype.type(1)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        n = len(texts)
        grams = np.zeros(n)
        hits = np.zeros((n, len(self.languages)))
        for rows, keys in trigrams(texts):
            grams += np.bincount(rows, minlength=n)
            slots = [s.astype(np.int64) for s in slots_of(keys, self.slot_bits, self.hashes)]
            for w, table in enumerate(self.words):
                mask = table[slots[0]]
                for s in slots[1:]:
                    mask &= table[s]
                for i in range(64 * w, min(64 * w + 64, len(self.languages))):
                    hits[:, i] += np.bincount(rows, self._bit(mask, i), n)
        if not self.languages:
            return [UNDETERMINED] * n, [0.0] * n
        real = np.maximum(0, (hits - grams[:, None] * self.false_rate) / (1 - self.false_rate))
        best, total = real.argmax(1), real.sum(1)
        names, scores = [], []
        for i in range(n):
            if not grams[i]:
                names.append(UNDETERMINED)
                scores.append(0.0)
            elif not total[i]:
                names.append(self.fallback)
                scores.append(0.0)
            else:
                names.append(self.languages[best[i]])
                scores.append(float(real[i, best[i]] / total[i]))
        return names, scores


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of ``docs`` (lang, text)."""
    def run(batches):
        held: dict[str, list] = {}
        size = 0

        def flush():
            for lang, parts in held.items():
                keys = np.concatenate([k for k, _ in parts])
                counts = np.concatenate([c for _, c in parts])
                keys, at = np.unique(keys, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys),
                     pa.array(np.bincount(at, counts).astype(np.int64))], names=["lang", "gram", "n"])

        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in dict.fromkeys(langs):
                for _, keys in trigrams([t for x, t in zip(langs, texts) if x == lang]):
                    held.setdefault(lang, []).append(np.unique(keys, return_counts=True))
                    size += len(held[lang][-1][0])
            if size > HELD_GRAMS:
                yield from flush()
                held, size = {}, 0
        yield from flush()

    return (docs.mapInArrow(run, "lang string, gram bigint, n bigint")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def mask_type(languages: int) -> type:
    """The narrowest mask with a bit for each language; more than 64 take several tables of wide masks."""
    return next((t for b, t in ((8, np.uint8), (16, np.uint16), (32, np.uint32)) if languages <= b), np.uint64)


def slot_bits_for(grams: int, languages: int, table_bytes: int = TABLE_BYTES) -> int:
    """Bits of the slot number for a largest filter of ``grams`` trigrams, within ``table_bytes``."""
    width = np.dtype(mask_type(languages)).itemsize * max(1, -(-languages // 64))
    most = max(1, table_bytes // width).bit_length() - 1
    return max(1, min(most, max(SLOT_BITS, (SLOTS_PER_GRAM * grams - 1).bit_length())))


def slot_table(chosen: DataFrame, languages: list[str], slot_bits: int, hashes: int) -> list[np.ndarray]:
    """The tables of ``chosen`` (language number, gram), put together on the executors."""
    kind = mask_type(len(languages))
    tables = [np.zeros(1 << slot_bits, kind) for _ in range(max(1, -(-len(languages) // 64)))]
    per_row = min(SLOTS_PER_ROW, 1 << slot_bits)

    def marks(batches):
        for batch in batches:
            code = batch.column(0).to_numpy()
            for slots in slots_of(batch.column(1).to_numpy(), slot_bits, hashes):
                masks = np.left_shift(np.uint64(1), (code % 64).astype(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((code // 64).astype(np.int32)), pa.array(slots.astype(np.int64)), pa.array(masks)],
                    names=["word", "slot", "mask"])

    def rows(batches):
        held: dict = {}
        for batch in batches:
            words, slots, masks = (batch.column(i).to_numpy() for i in range(3))
            for word, part in set(zip(words.tolist(), (slots // per_row).tolist())):
                own = (words == word) & (slots // per_row == part)
                if (word, part) not in held:
                    held[word, part] = np.zeros(per_row, kind)
                held[word, part][slots[own] % per_row] = masks[own].view(np.uint64).astype(kind)
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in held], pa.int32()), pa.array([p for _, p in held], pa.int64()),
                 pa.array([m.tobytes() for m in held.values()], pa.binary())], names=["word", "part", "masks"])

    slots = (chosen.mapInArrow(marks, "word int, slot bigint, mask bigint")
             .groupBy("word", "slot").agg(F.bit_or("mask").alias("mask")))
    # Few parts per task, so that a task holds little; the driver gets the tables' bytes and no more.
    found = slots.repartition("word", F.floor(F.col("slot") / per_row)).mapInArrow(
        rows, "word int, part bigint, masks binary")
    for row in found.collect():
        tables[row["word"]][row["part"] * per_row:][:per_row] = np.frombuffer(row["masks"], kind)
    return tables


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
        slot_bits: int | None = None, hashes: int = HASHES, table_bytes: int = TABLE_BYTES) -> Model:
    """A model of all rows with a text and a language; no such row gives a model without
    languages. The driver gets a row per language and the slots. Without ``slot_bits`` the tables are
    sized by the trigrams of the language that has the most, within ``table_bytes``."""
    rows = docs.select(docs[lang_col].cast("string").alias("lang"), docs[text_col].alias("text"))
    counts = written(gram_counts(rows.filter("lang IS NOT NULL AND text IS NOT NULL")))
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    rated = counts.join(total, "lang").withColumn("rate", F.col("n") / F.col("total"))
    top = rated.groupBy("gram").agg(F.max("rate").alias("top"))
    chosen = written(rated.join(top, "gram").filter(F.col("rate") >= RATE_SHARE * F.col("top"))
                     .select("lang", "gram", "total"))
    kept = chosen.groupBy("lang").agg(F.max("total").alias("total"), F.count("*").alias("grams")).orderBy("lang").collect()
    languages = [r["lang"] for r in kept]
    if slot_bits is None:
        slot_bits = slot_bits_for(max((r["grams"] for r in kept), default=0), len(languages), table_bytes)
    names = docs.sparkSession.createDataFrame([*enumerate(languages)], "code int, name string")
    coded = chosen.join(names, chosen["lang"] == names["name"]).select("code", "gram")
    words = slot_table(coded, languages, slot_bits, hashes)
    fallback = min(kept, key=lambda r: (-r["total"], r["lang"]), default={"lang": UNDETERMINED})["lang"]
    return Model(languages, fallback, words, slot_bits, hashes)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, lang_pred, score (the decided language's share of the corrected hits).

    A null text, or one without a letter, is ``und`` with score 0. A text with letters of which no
    trigram is known gets the language with the most text, with score 0. Of equal hits the first
    language in order wins.
    """
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.languages, model.fallback, model.words, model.slot_bits, model.hashes))

    def run(batches):
        own = Model(*shared.value)
        for batch in batches:
            names, scores = own.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    rows = pick(docs, id_col, text_col, null_text=None)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``predict`` does not call ``und``."""
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.languages, model.fallback, model.words, model.slot_bits, model.hashes))
    at = docs.columns.index(text_col)

    def run(batches):
        own = Model(*shared.value)
        for batch in batches:
            names, _ = own.predict(batch.column(at).to_pylist())
            yield batch.filter(pa.array([n != UNDETERMINED for n in names], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def learning_rows(docs: DataFrame, id_col: str = "doc_id", folds: int = 5) -> DataFrame:
    """The rows to learn from: all but the held-out fold."""
    return docs.filter(remainder(docs[id_col], folds) != 0)
