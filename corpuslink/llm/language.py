"""Language identification from averaged hashed subword embeddings."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslink.llm.batches import map_batches, row_groups, text_bytes

#: Multipliers of the bytes of a subword, and one more that tells sizes apart: any odd numbers.
MIX = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], np.uint32)
#: Bytes as subwords see them: ASCII that is no letter is a word border.
BORDER = 32
SEEN = np.array([b if b >= 128 or chr(b).isalpha() else BORDER for b in range(256)], np.uint8)
UNKNOWN = "und"


def subwords(column: pa.Array, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, buckets of all subwords, subwords per row) of groups of rows.

    Subwords are the runs of three and of four lower-cased bytes that have at most one
    word border at either end; whole texts are read.
    """
    data, bounds = text_bytes(pc.utf8_lower(column))
    for first, last in row_groups(bounds, 1 << 20):
        sizes = np.diff(bounds[first:last + 1])
        text = SEEN[data[bounds[first]:bounds[last]]]
        row = np.repeat(np.arange(last - first), sizes)
        at = np.arange(len(text)) + row + 1  # one border before each text
        laid = np.full(len(text) + last - first + 3, BORDER, np.uint8)
        laid[at] = text
        at, row = at[text != BORDER], row[text != BORDER]
        wide = laid.astype(np.uint32)
        three = wide[at - 1] * MIX[0] + wide[at] * MIX[1] + wide[at + 1] * MIX[2]
        inner = laid[at + 1] != BORDER
        four = three[inner] + wide[at[inner] + 2] * MIX[3] + MIX[3]
        keys = np.concatenate([three, four])
        keys = (keys ^ (keys >> np.uint32(15))) * MIX[2] >> np.uint32(32 - buckets.bit_length() + 1)
        rows = np.concatenate([row, row[inner]])
        order = np.argsort(rows, kind="stable")
        yield first, keys[order], np.bincount(rows, minlength=last - first)


@dataclass
class Model:
    """Scores of buckets per language (embeddings times output layer), bias and calibration."""

    langs: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def predict(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Index of the best language and its calibrated probability, for each text."""
        best, score = np.zeros(len(column), np.int64), np.zeros(len(column))
        for first, keys, sizes in subwords(column, len(self.table)):
            rows = np.flatnonzero(sizes)
            if not len(rows):
                continue
            starts = np.cumsum(sizes) - sizes
            sums = np.add.reduceat(self.table[keys], starts[rows], axis=0)
            p = softmax((sums / sizes[rows, None] + self.bias) / self.temperature)
            best[first + rows], score[first + rows] = p.argmax(1), p.max(1)
        return best, score


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], buckets: int, dims: int = 16,
          epochs: int = 8, rate: float = 1.0, rejected: float = 0.001, seed: int = 7) -> Model:
    """Fit by stochastic gradient descent on (language, buckets, shares) rows.

    A text is the mean of the embeddings of its subwords; a linear softmax reads it.
    A fifth of the rows is held back to calibrate: the temperature with the least
    loss, and the threshold below which at most the share `rejected` of rightly
    recognised texts lies (half of the smallest probability, if that is no whole text).
    """
    rng = np.random.default_rng(seed)
    langs = sorted({r[0] for r in rows})
    target = {name: k for k, name in enumerate(langs)}
    order = rng.permutation(len(rows))
    held = order[:len(rows) // 5]
    fit = order[len(rows) // 5:]
    embed = rng.uniform(-1, 1, (buckets, dims)) / dims
    out, bias = np.zeros((dims, len(langs))), np.zeros(len(langs))
    steps, step = epochs * len(fit), 0
    for _ in range(epochs):
        for k in rng.permutation(fit):
            lang, idx, share = rows[k]
            lr = rate * (1 - step / steps)
            step += 1
            text = share @ embed[idx]
            error = softmax(text @ out + bias)
            error[target[lang]] -= 1
            back = out @ error
            out -= lr * np.outer(text, error)
            bias -= 0.1 * lr * error
            embed[idx] -= lr * share[:, None] * back * len(idx) ** 0.5
    model = Model(langs, (embed @ out).astype(np.float32), bias)
    if len(held):
        logits = np.array([rows[k][2] @ model.table[rows[k][1]] + bias for k in held])
        truth = np.array([target[rows[k][0]] for k in held])
        grid = np.geomspace(0.1, 10, 81)
        model.temperature = float(min(grid, key=lambda t: -np.log(
            softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean()))
        p = softmax(logits / model.temperature)
        right = np.sort(p.max(1)[p.argmax(1) == truth])
        if len(right):
            k = int(rejected * (len(right) + 1))
            model.threshold = float(right[k - 1] if k else right[0] / 2)
    return model


def held_out(id_col: str) -> F.Column:
    """Rows whose crc32(id as text) leaves 1 when divided by three; they are never learned from."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang", per_language: int = 800, buckets: int = 1 << 15) -> Model | None:
    """Learn from about `per_language` labelled rows of each language, or all if there are fewer.

    Rows are drawn by a hash of id and text among those that are not held out and whose
    text and language are not null; equal rows count as one, so neither an id that many
    rows share nor repeated rows can fill or miss the draw. Their whole texts become counts
    of buckets in the tasks, so what reaches the driver is bounded by rows and buckets.
    None without rows.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                       F.col(f"`{lang_col}`").cast("string").alias("lang")).where(
        ~held_out("doc_id") & F.col("doc_id").isNotNull() & F.col("text").isNotNull()
        & F.col("lang").isNotNull())
    mark = F.xxhash64("doc_id", "text")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(
        F.approx_count_distinct(mark, 0.02).alias("n")).collect()}
    if not counts:
        return None
    draw = F.pmod(mark, F.lit(1 << 40)) / float(1 << 40)
    share = F.create_map(*[F.lit(x) for n, c in sorted(counts.items()) for x in (n, min(1.0, per_language / c))])
    drawn = rows.where(draw < share[F.col("lang")]).distinct()

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            idx, share = [], []
            for _, keys, sizes in subwords(batch.column("text"), buckets):
                for part in np.split(keys, np.cumsum(sizes)[:-1]):
                    found, n = np.unique(part, return_counts=True)
                    idx.append(found.astype("<i4").tobytes())
                    share.append((n / max(1, n.sum())).astype("<f4").tobytes())
            return {"lang": batch.column("lang"), "doc_id": batch.column("doc_id").cast(pa.string()),
                    "idx": idx, "share": share}

        return step

    schema = "lang string, doc_id string, idx binary, share binary"
    got = sorted(map(tuple, map_batches(drawn, make, schema).collect()))
    fitted = [(lang, np.frombuffer(i, "<i4"), np.frombuffer(s, "<f4").astype(float))
              for lang, _, i, s in got if i]
    return train(fitted, buckets) if fitted else None


def identify_languages(docs: DataFrame, model: Model | None, id_col: str = "doc_id",
                       text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Language of every whole text: doc_id, lang_pred, score (0 to 1) and accepted.

    Only the text is looked at. A null text or one without any letter is `und` with
    score 0 and not accepted; so is every text when there is no model. Other texts
    get a learned language; those whose calibrated probability is below the model's
    threshold are not accepted. One row per input row, repeated rows included; columns
    `keep` come along, but those that are named like results.
    """
    keep = tuple(c for c in keep if c not in ("doc_id", "lang_pred", "score", "accepted"))
    carried = [F.col(f"`{c}`").alias(f"keep_{k}") for k, c in enumerate(keep)]
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                       F.coalesce(F.col(f"`{text_col}`").rlike("\\p{L}"), F.lit(False)).alias("lettered"), *carried)
    kinds = dict(docs.dtypes)

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            n = batch.num_rows
            known = batch.column("lettered").to_numpy(zero_copy_only=False) & (model is not None)
            best, score = model.predict(batch.column("text")) if model else (np.zeros(n, int), np.zeros(n))
            langs = [model.langs[b] if k else UNKNOWN for b, k in zip(best, known)]
            score = np.where(known, score, 0.0)
            accepted = known & (score >= (model.threshold if model else 1))
            return {"doc_id": batch.column("doc_id"), "lang_pred": langs, "score": score,
                    "accepted": accepted, **{f"keep_{k}": batch.column(f"keep_{k}") for k in range(len(keep))}}

        return step

    kept = "".join(f", keep_{k} {kinds[c]}" for k, c in enumerate(keep))
    out = map_batches(rows, make, f"doc_id {kinds[id_col]}, lang_pred string, score double, accepted boolean{kept}")
    return out.withColumnsRenamed({f"keep_{k}": c for k, c in enumerate(keep)})
