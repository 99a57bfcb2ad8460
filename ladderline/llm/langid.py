"""Language identification by unigram piece models, summed over all segmentations.

The pieces are the byte strings of a fixed public vocabulary, which holds every single byte, so every text has
segmentations. A language gives each piece a probability; a word, with the space before it, has the sum over all its
segmentations of the products of their pieces, which a forward pass computes. The probabilities are fitted to the word
counts of the training texts of each language by expectation maximisation, forward and backward over every distinct
word, with the expected piece counts added up in Spark. A text is scored by the sum of its words' log-probabilities and
the language's share of texts; the score is the posterior of the best language.

Words are lower-cased in A-Z. Forward passes run over all distinct words of a length in a piece of a batch at once; words
beyond ``SHORT`` bytes, whose products might underflow, are summed one by one in logarithms, whole as well.

Defined cases: a text that is null or has no letter is ``und`` with score 0, as is every text if there is no training
text with a language. Ties go to the language that sorts first. Rows are judged alone. The model is of (pieces x
languages) numbers: 400 KB for each language, held by every worker.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladderline.llm import kernel
from ladderline.llm.lookup import Lookup
from ladderline.llm.ppm import held_out
from ladderline.session import stage

SHORT, ROUNDS, SMOOTHING = 20, 3, 0.1
KNOWN = 1 << 20
"""Words whose scores a worker remembers."""
_STEP = np.uint64(0x100000001B3)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(2)
def pieces_of(path: str) -> tuple[int, Lookup]:
    """Number of pieces, and their numbers by hash of their bytes."""
    import base64

    with open(path, "rb") as file:
        pieces = [base64.b64decode(line.split()[0]) for line in file if line.strip()]
    pieces = sorted({*pieces} | {bytes([b]) for b in range(256)})
    keys = np.array([_hash_of(p) for p in pieces], dtype=np.uint64)
    order = np.argsort(keys)
    table = Lookup(keys[order], order.astype(np.int64), room=16)
    table.longest = max(map(len, pieces))
    return len(pieces), table


def _hash_of(piece: bytes) -> int:
    h = 0
    for b in piece:
        h = (h * int(_STEP) + b + 1) & 0xFFFFFFFFFFFFFFFF
    return h


def _spans(words: np.ndarray, table: Lookup) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(start, end, rows, pieces)`` of every span that is a piece in some of the words, by rising end."""
    n = words.shape[1]
    hashes = [np.zeros(len(words), dtype=np.uint64) for _ in range(n)]
    for end in range(1, n + 1):
        byte = words[:, end - 1].astype(np.uint64) + np.uint64(1)
        for start in range(end):
            hashes[start] = hashes[start] * _STEP + byte
        places = table.places(np.concatenate(hashes[:end])).reshape(end, -1)
        for start in range(end):
            rows = np.flatnonzero(places[start] >= 0)
            if len(rows):
                yield start, end, rows, table.values[places[start, rows]]


def _long_spans(word: bytes, table: Lookup) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, pieces)`` of all spans of one word that are a piece, by rising end."""
    data = np.frombuffer(word, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    hashes = np.zeros(len(data), dtype=np.uint64)
    found = []
    for length in range(1, min(table.longest, len(data)) + 1):
        hashes = hashes[: len(data) - length + 1] * _STEP + data[length - 1 :]
        places = table.places(hashes)
        starts = np.flatnonzero(places >= 0)
        found.append((starts, starts + length, table.values[places[starts]]))
    starts, ends, pieces = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(ends, kind="stable")
    return starts[order], ends[order], pieces[order]


def _summed(starts: np.ndarray, ends: np.ndarray, logs: np.ndarray, n: int) -> np.ndarray:
    """Per position the log of the sum over all ways there from position 0; spans by rising end, ``logs`` by language."""
    out = np.full((n + 1, logs.shape[1]), -np.inf)
    out[0] = 0.0
    cuts = np.searchsorted(ends, np.arange(1, n + 2))
    for end in range(1, n + 1):
        ways = out[starts[cuts[end - 1] : cuts[end]]] + logs[cuts[end - 1] : cuts[end]]
        out[end] = np.logaddexp.reduce(ways, axis=0)
    return out


def _by_length(words: list[bytes]) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[int]]:
    """Words with their space: those up to ``SHORT`` bytes as a matrix for each length, and the places of the others."""
    lengths = np.array([len(w) + 1 for w in words], dtype=np.int64)
    short = []
    for n in np.unique(lengths[lengths <= SHORT]).tolist():
        at = np.flatnonzero(lengths == n)
        short.append((at, np.frombuffer(b" " + b" ".join(words[i] for i in at), dtype=np.uint8).reshape(-1, n)))
    return short, np.flatnonzero(lengths > SHORT).tolist()


def log_probabilities(words: list[bytes], model: np.ndarray, table: Lookup) -> np.ndarray:
    """For each word and language the log of the sum over all segmentations; ``model``: pieces by languages."""
    out = np.zeros((len(words), model.shape[1]))
    short, long = _by_length(words)
    for at, rows in short:
        forward = np.zeros((rows.shape[1] + 1, len(rows), model.shape[1]))
        forward[0] = 1
        for start, end, some, pieces in _spans(rows, table):
            forward[end, some] += forward[start, some] * model[pieces]
        out[at] = np.log(forward[-1])
    for at in long:
        starts, ends, pieces = _long_spans(b" " + words[at], table)
        out[at] = _summed(starts, ends, np.log(model[pieces]), len(words[at]) + 1)[-1]
    return out


def expected_pieces(words: list[bytes], times: np.ndarray, language: np.ndarray, model: np.ndarray, table: Lookup) -> np.ndarray:
    """Expected number of each piece in each language over all segmentations of words that occur ``times`` in ``language``."""
    out = np.zeros(model.size)
    short, long = _by_length(words)
    for at, rows in short:
        n, own = rows.shape[1], language[at]
        spans = [(s, e, some, pieces, model[pieces, own[some]]) for s, e, some, pieces in _spans(rows, table)]
        forward, backward = np.zeros((n + 1, len(rows))), np.zeros((n + 1, len(rows)))
        forward[0] = backward[n] = 1
        for s, e, some, _, p in spans:
            forward[e, some] += forward[s, some] * p
        for s, e, some, _, p in sorted(spans, key=lambda x: -x[0]):
            backward[s, some] += backward[e, some] * p
        weight = times[at] / forward[n]
        if spans:
            shares = [forward[s, some] * p * backward[e, some] * weight[some] for s, e, some, _, p in spans]
            places = [pieces * model.shape[1] + own[some] for _, _, some, pieces, _ in spans]
            out += np.bincount(np.concatenate(places), weights=np.concatenate(shares), minlength=model.size)
    for at in long:
        n, own = len(words[at]) + 1, language[at]
        starts, ends, pieces = _long_spans(b" " + words[at], table)
        logs = np.log(model[pieces, own])[:, None]
        ahead = _summed(starts, ends, logs, n)[:, 0]
        back = np.argsort(n - starts, kind="stable")
        behind = _summed(n - ends[back], n - starts[back], logs[back], n)[::-1, 0]
        share = np.exp(ahead[starts] + logs[:, 0] + behind[ends] - ahead[n]) * times[at]
        np.add.at(out, pieces * model.shape[1] + own, share)
    return out.reshape(model.shape)


def _distinct(words: kernel.Words) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Hashes and bytes of the distinct words, and for each word which of them it is."""
    found, first, back = np.unique(words.hashes(), return_index=True, return_inverse=True)
    data = words.data.tobytes()
    return found, [data[a:b] for a, b in zip(words.starts[first].tolist(), words.ends[first].tolist(), strict=True)], back


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in kernel.pieces(batches, "text", 4 * kernel.SLICE):
        words = kernel.words_of(piece.column("text"), lower=True)
        _, distinct, back = _distinct(words)
        lang = piece.column("lang").dictionary_encode()
        own = np.repeat(lang.indices.to_numpy(), words.counts)
        pairs, n = np.unique(back * len(lang.dictionary) + own, return_counts=True)
        word = pa.array(distinct, pa.binary()).take(pa.array(pairs // len(lang.dictionary)))
        yield pa.RecordBatch.from_arrays([lang.dictionary.take(pa.array(pairs % len(lang.dictionary))), word, pa.array(n)], names=["lang", "word", "n"])


def _expect(path: str, model: Broadcast, languages: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces_of(path)[1]
        number = {name: i for i, name in enumerate(languages)}
        total = np.zeros(model.value.shape)
        for batch in batches:
            if batch.num_rows:
                own = np.array([number[x] for x in batch.column("lang").to_pylist()])
                total += expected_pieces(batch.column("word").to_pylist(), batch.column("n").to_numpy().astype(float), own, model.value, table)
        piece, lang = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(lang), pa.array(total[piece, lang])], names=["piece", "lang", "n"])

    return run


class _Scores:
    """Log-probabilities of words by hash; the remembered ones are dropped when there are too many."""

    def __init__(self, model: np.ndarray, table: Lookup):
        self.model, self.table = model, table
        self.clear()

    def clear(self) -> None:
        self.keys, self.values = np.empty(0, np.uint64), np.empty((0, self.model.shape[1]))

    def of(self, hashes: np.ndarray, words: list[bytes]) -> np.ndarray:
        """``hashes`` are distinct and sorted."""
        if len(self.keys) > KNOWN:
            self.clear()
        place = np.minimum(np.searchsorted(self.keys, hashes), max(len(self.keys) - 1, 0))
        known = self.keys[place] == hashes if len(self.keys) else np.zeros(len(hashes), dtype=bool)
        out = np.empty((len(hashes), self.model.shape[1]))
        out[known] = self.values[place[known]]
        fresh = np.flatnonzero(~known)
        out[fresh] = log_probabilities([words[i] for i in fresh], self.model, self.table)
        at = np.searchsorted(self.keys, hashes[fresh])
        self.keys, self.values = np.insert(self.keys, at, hashes[fresh]), np.insert(self.values, at, out[fresh], axis=0)
        return out


_held: dict[str, _Scores] = {}
"""The scores of the model that a worker used last, kept from task to task."""


def _scores_of(name: str, model: Broadcast, path: str) -> _Scores:
    if name not in _held:
        _held.clear()
        _held[name] = _Scores(model.value, pieces_of(path)[1])
    return _held[name]


def _predict(path: str, model: Broadcast, prior: np.ndarray, languages: list[str]):
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scores_of(name, model, path)
        names = np.array(languages, dtype=object)
        for piece in kernel.pieces(batches, "text"):
            words = kernel.words_of(piece.column("text"), lower=True)
            found, distinct, back = _distinct(words)
            by_word = scores.of(found, distinct)
            total = np.stack([np.add.reduceat(np.append(by_word[back, k], 0.0), words.offsets[:-1]) for k in range(len(names))], axis=1)
            total[words.counts == 0] = 0
            total += prior
            best = total.argmax(axis=1)
            score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            letters = piece.column("letters").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), pa.array(np.where(letters, names[best], "und"), pa.string()), pa.array(np.where(letters, score, 0.0))], names=["id", "lang_pred", "score"]
            )

    return run


def fitted(training: DataFrame, path: str, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log share of texts and piece probabilities, from ``(text, lang)``."""
    spark = training.sparkSession
    shares = sorted(map(tuple, training.groupBy("lang").agg(F.count("*")).collect()))
    languages = [lang for lang, _ in shares]
    texts = np.array([n for _, n in shares], dtype=float)
    pieces = pieces_of(path)[0]
    model = np.full((pieces, len(languages)), 1 / pieces)
    counted = training.mapInArrow(_count_words, "lang string, word binary, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = stage(counted, "words")
    for _ in range(rounds if languages else 0):
        held = spark.sparkContext.broadcast(model)
        expected = words.mapInArrow(_expect(path, held, languages), "piece bigint, lang bigint, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n"))
        found = expected.toArrow()  # pieces x languages at most
        model = np.full((pieces, len(languages)), SMOOTHING)
        model[found.column("piece").to_numpy(), found.column("lang").to_numpy()] += found.column("n").to_numpy()
        model /= model.sum(axis=0)
    return languages, np.log(texts / texts.sum()) if languages else texts, model


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", parts: int = 3, rest: int = 1, path: str | None = None) -> DataFrame:
    """``(id, held_out, lang_pred, score)`` of every row; texts whose id has remainder ``rest`` are kept out of the training."""
    path = path or default_vocabulary()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    training = rows.where(~held_out("id", parts, rest) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    languages, prior, model = fitted(training, path)
    asked = rows.select("id", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    if not languages:
        out = asked.select("id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    else:
        held = docs.sparkSession.sparkContext.broadcast(model)
        out = asked.mapInArrow(_predict(path, held, prior, languages), f"id {rows.schema['id'].dataType.simpleString()}, lang_pred string, score double")
    return out.select("id", held_out("id", parts, rest).alias("held_out"), "lang_pred", "score")
