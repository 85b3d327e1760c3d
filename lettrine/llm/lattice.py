"""Document probability from a subword lattice.

The pieces are those of an existing vocabulary; their unigram scores are counted
on the training texts. A word's probability is the sum over all its
segmentations, by a forward recursion in log space; characters that are no piece
are spelled in byte pieces. Words of the training texts are further arcs, over
the whole word: they share 1 - u of the mass by their counts, and the
segmentations share u, the share of words seen once (Good and Turing's estimate
of what is still unseen). A document is its words and one end, so its marginal
probability is the product over them.

Texts are dealt to blocks of about ``block_bytes``. A block asks for its
distinct words once and gets their probabilities back, so what is shuffled is
the texts once and distinct words per block and task, and no vocabulary is held whole.
Rows that repeat are folded where they are read: about ``block_bytes`` of a task's rows
send one of each, with the number of its copies, so no block holds them all.

Null texts are empty: an end alone. With no training text the words have only
their lattice, with equal pieces. Repeated rows are given out each; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import lean, settled, slices

LN10 = math.log(10)


class Lattice:
    """``counts``: piece number -> count in training text."""

    def __init__(self, path: str, counts: dict[int, int]):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        total = math.log(sum(counts.values()) + size)
        self.pieces: dict[str, float] = {}
        self.bytes = [0.0] * 256
        for i in range(size):
            logp = math.log(counts.get(i, 0) + 1) - total
            if model.is_byte(i):
                self.bytes[int(model.id_to_piece(i)[1:-1], 16)] = logp
            elif not model.is_control(i) and not model.is_unknown(i):
                self.pieces[model.id_to_piece(i)] = logp
        self.longest = max(map(len, self.pieces))

    def log_probabilities(self, words: list[str]) -> list[float]:
        """Natural logarithms of the sums over all segmentations of the words, with the mark of a word's start.

        The words are taken in order, so that the recursion goes on from the
        letters that one shares with the one before it.
        """
        get, longest = self.pieces.get, self.longest
        log, exp = math.log, math.exp
        out = [0.0] * len(words)
        last, forward = "", [0.0]
        for i in sorted(range(len(words)), key=words.__getitem__):
            text = "▁" + words[i]
            same = 0
            for x, y in zip(last, text):
                if x != y:
                    break
                same += 1
            del forward[same + 1 :]
            for end in range(same + 1, len(text) + 1):
                terms = [forward[start] + p for start in range(max(0, end - longest), end) if (p := get(text[start:end])) is not None]
                if get(text[end - 1]) is None:
                    terms.append(forward[end - 1] + sum([self.bytes[b] for b in text[end - 1].encode("utf-8", "surrogatepass")]))
                if len(terms) == 1:
                    forward.append(terms[0])
                else:
                    most = max(terms)
                    forward.append(most + log(sum([exp(t - most) for t in terms])))
            last = text
            out[i] = forward[len(text)]
        return out


def count_pieces(words: DataFrame, vocabulary: str) -> dict[int, int]:
    """Counts of the vocabulary's pieces in ``words`` (word, n): at most as many numbers as it has pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        counts: Counter = Counter()
        for batch in batches:
            found = batch.column("word").to_pylist()
            for ids, n in zip(model.encode([w.decode("utf-8", "replace") for w in found], num_threads=1), batch.column("n").to_pylist()):
                for i in ids:
                    counts[i] += n
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())], ["piece", "n"])

    rows = words.select("word", "n").mapInArrow(lean(run), "piece int, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect()
    return {r["piece"]: r["n"] for r in rows}


def split(text: str | None) -> list[bytes]:
    """A-Z lowered; bytes.split() parts at x20 and x09 to x0D, as the definition of words has it."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def folded(docs: DataFrame, block_bytes: int) -> DataFrame:
    """doc_id, text, copies: the rows that a task reads, ``block_bytes`` at a time, with equal ones as one."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        copies: Counter = Counter()
        size = 0

        def rows() -> pa.RecordBatch:
            ids, texts = zip(*copies) if copies else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(list(copies.values()), pa.int64())], ["doc_id", "text", "copies"])

        for ids, texts in slices(batches, ["doc_id", "text"]):
            for row in zip(ids, texts):
                size += 0 if row in copies else 64 + len(row[1] or "")  # a row weighs something without text too
                copies[row] += 1
            if size > block_bytes:
                yield rows()
                copies.clear()
                size = 0
        yield rows()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(fold), "doc_id long, text string, copies long")


def score_documents(docs: DataFrame, vocabulary: str, train: str = "train", block_bytes: int = 8 << 20) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score, both log10; ``train`` names a boolean column of ``docs``."""
    size = docs.agg(F.sum(F.octet_length("text")), F.count_if(train)).first()
    n_blocks, ends = max(1, -(-(size[0] or 0) // block_bytes)), size[1]

    blocked = folded(docs, block_bytes).withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        size = 0

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

        for learns, texts in slices(batches, ["train", "text"]):
            for learn, text in zip(learns, texts):
                if learn:
                    counts.update(split(text))
                else:
                    counts.update(dict.fromkeys(split(text), 0))
                size += len(text or "")
            if size > block_bytes:
                yield rows()
                counts.clear()
                size = 0
        yield rows()

    def ask(table: pa.Table) -> pa.Table:
        words: set = set()
        for text in table.column("text").to_pylist():
            words.update(split(text))
        return pa.table({"block": pa.array([table.column("block")[0].as_py()] * len(words), pa.int64()), "word": pa.array(list(words), pa.binary())})

    learned = docs.select(F.col(train).alias("train"), "text").mapInArrow(lean(count), "word binary, n long")
    counted = settled(learned.groupBy("word").agg(F.sum("n").alias("n")))
    asked = blocked.groupBy("block").applyInArrow(ask, "block long, word binary")
    known = counted.where("n > 0")
    total, distinct, once = known.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.count_if(F.col("n") == 1)).first()
    pieces = count_pieces(known, vocabulary)
    tokens, kinds = total + ends, distinct + (ends > 0)
    unseen = min(0.5, max(1e-4, once / tokens)) if total else 1.0
    base_of = math.log10(tokens + kinds + 1)
    end_base = math.log10(ends + 1) - base_of
    end_score = math.log10((1 - unseen if total else 1.0) * ends / tokens) if ends else end_base

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(vocabulary, pieces)
        for batch in batches:
            scores = []
            spelled = lattice.log_probabilities([w.decode("utf-8", "replace") for w in batch.column("word").to_pylist()])
            for lattice_score, n in zip(spelled, batch.column("n").to_pylist()):
                score = math.log(unseen) + lattice_score
                if n:
                    whole = math.log((1 - unseen) * n / tokens)
                    most = max(whole, score)
                    score = most + math.log(math.exp(whole - most) + math.exp(score - most))
                scores.append(score / LN10)
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(scores, pa.float64())], ["word", "n", "p"])

    weighed = counted.mapInArrow(lean(weigh), "word binary, n long, p double")
    answered = asked.join(weighed, "word")

    def add(texts: pa.Table, answers: pa.Table) -> pa.Table:
        place = {w: i for i, w in enumerate(answers.column("word").to_pylist())}
        n, score = answers.column("n").to_numpy(), answers.column("p").to_numpy()
        base = np.log10(n + 1) - base_of
        out: dict[str, list] = {k: [] for k in ("n_tokens", "n_known", "base_score", "score")}
        for text in texts.column("text").to_pylist():
            at = np.array([place[w] for w in split(text)], np.int64)
            out["n_tokens"].append(len(at) + 1)
            out["n_known"].append(int((n[at] > 0).sum()) + (ends > 0))
            out["base_score"].append(float(base[at].sum()) + end_base)
            out["score"].append(float(score[at].sum()) + end_score)
        return pa.table({"doc_id": texts.column("doc_id"), "copies": texts.column("copies"), "n_tokens": pa.array(out["n_tokens"], pa.int64()), "n_known": pa.array(out["n_known"], pa.int64()), "train_tokens": pa.array([tokens] * len(texts), pa.int64()), "base_score": pa.array(out["base_score"], pa.float64()), "score": pa.array(out["score"], pa.float64())})

    scored = blocked.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(add, "doc_id long, copies long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return scored.withColumn("copy", F.explode(F.expr("array_repeat(true, int(copies))"))).drop("copies", "copy")
