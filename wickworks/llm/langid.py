"""Language ID by unigram piece models, marginalised over all segmentations.

Every language has a probability for each piece of a fixed public vocabulary.
A word's probability is the sum, over all ways to cut it into pieces, of the
product of their probabilities; the forward algorithm gives that sum, and the
forward-backward pass the expected piece counts that refine the model (EM).
A text's score is the product over its words.

Words are white-space tokens, lower-cased, with only their letters kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickworks.llm.base import hidden, shown, split_words, text_slices, written

UNDETERMINED = "und"
WORD_START = "▁"  # fixed value: the vocabulary's mark of a word's beginning
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
CACHED_WORDS = 400_000
TRAINED_WORDS = 50_000
# Letters of a word that training goes through at once; longer words count in parts.
STRETCH = 1024


def vocabulary(path: str = VOCABULARY) -> list[str]:
    """The vocabulary's pieces of letters, lower-cased, in order of id, each once."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i).lower() for i in range(model.get_piece_size()))
    return list(dict.fromkeys(p for p in pieces if p.removeprefix(WORD_START).isalpha()))


def is_held_out(doc_id: str = "doc_id", fold: int = 2, folds: int = 4) -> Column:
    """crc32 of the id as text, modulo ``folds``, is ``fold``; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))


class Pieces:
    """Finds all pieces inside equally long words, by hashes of their code points."""

    def __init__(self, pieces: list[str]):
        self.size = len(pieces)
        self.longest = max((len(p) for p in pieces), default=1)
        self.tables: list[tuple[np.uint64, np.ndarray, np.ndarray]] = []
        left = [(self._hash(p), i) for i, p in enumerate(pieces)]
        while left:  # each table holds what fell on a free slot
            mul = 0x9E3779B97F4A7C15 + 2 * len(self.tables) * 0x51ED27
            keys, ids = np.zeros(1 << 18, np.uint64), np.full(1 << 18, -1, np.int32)
            over = []
            for h, i in left:
                at = (h * mul & (2**64 - 1)) >> 46
                if ids[at] < 0:
                    keys[at], ids[at] = h, i
                else:
                    over.append((h, i))
            self.tables.append((np.uint64(mul), keys, ids))
            left = over

    @staticmethod
    def _hash(p: str) -> int:
        h = 0
        for c in p:
            h = ((h ^ ord(c)) * 0x100000001B3 + 0x7F4A7C15) & (2**64 - 1)
        return h

    def find(self, points: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
        """(begin, end) -> id of that piece in each word; ``size`` if it is none.

        A single code point that is no piece counts as the unknown piece, ``size + 1``.
        """
        n, length = points.shape
        found = {}
        for i in range(length):
            h = np.zeros(n, np.uint64)
            for j in range(i + 1, min(length, i + self.longest) + 1):
                h = (h ^ points[:, j - 1]) * np.uint64(0x100000001B3) + np.uint64(0x7F4A7C15)
                ids = np.full(n, self.size, np.int32)
                for mul, keys, of in self.tables:
                    at = (h * mul) >> np.uint64(46)
                    hit = (keys[at] == h) & (of[at] >= 0)
                    ids[hit] = of[at[hit]]
                if j == i + 1:
                    ids[ids == self.size] = self.size + 1
                if j == i + 1 or (ids < self.size).any():
                    found[i, j] = ids
        return found


def _by_length(words: list[str], block: int = 20_000, mark: str = WORD_START) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in ``words``, code points with ``mark`` before them), of equal lengths."""
    lengths = np.array([len(w) for w in words], np.int64)
    order = np.argsort(lengths, kind="stable")
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(lengths[order])) + 1, [len(order)]))
    for a, b in zip(cuts[:-1], cuts[1:]):
        n = int(lengths[order[a]]) if b > a else 0
        step = max(1, min(block, 400_000 // (n + 1)))
        for c in range(a, b, step):
            at = order[c : min(b, c + step)]
            text = "".join(mark + words[i] for i in at)
            yield at, np.frombuffer(text.encode("utf-32-le"), np.uint32).reshape(len(at), n + len(mark)).astype(np.uint64)


def _forward(found: dict, n: int, length: int, p: np.ndarray, longest: int) -> tuple[list, np.ndarray]:
    """Scaled forward sums at each place, and the logarithm of the scale."""
    langs = p.shape[1]
    at, scale = [np.ones((n, langs))], np.zeros((n, langs))
    for j in range(1, length + 1):
        total = np.zeros((n, langs))
        for i in range(max(0, j - longest), j):
            if (i, j) in found:
                total += at[i] * p[found[i, j]]
        at.append(total)
        if j % 32 == 0:  # long words: keep the numbers away from zero
            by = np.maximum(total, 1e-290)
            for i in range(max(0, j - longest), j + 1):
                at[i] = at[i] / by
            scale += np.log(by)
    return at, scale


def log_likelihoods(words: list[str], pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """log of the summed probability of all segmentations: a row per word, a column per language.

    ``p``: a row per piece, then one of zeros, then the unknown piece's.
    """
    out = np.zeros((len(words), p.shape[1]))
    for at, points in _by_length(words):
        n, length = points.shape
        sums, scale = _forward(pieces.find(points), n, length, p, pieces.longest)
        out[at] = np.log(np.maximum(sums[length], 1e-290)) + scale
    return out


def expected_counts(words: list[str], weights: np.ndarray, pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations (p: one language, one column).

    Sums of every length stay in range: forward sums are kept as logarithms, and
    a piece's share in the sum of the place where it ends takes their stead on
    the way back.  A word of more than ``STRETCH`` letters counts in stretches
    of so many, over whose borders no piece reaches.
    """
    out = np.zeros(pieces.size + 2)
    parts = [(w[k : k + STRETCH], n) for word, n in zip(words, weights) for w in (WORD_START + word,) for k in range(0, len(w), STRETCH)]
    weights = np.array([n for _, n in parts], float)
    for at, points in _by_length([w for w, _ in parts], 10_000, ""):
        n, length = points.shape
        found = pieces.find(points)
        logs, share = np.zeros((length + 1, n)), {}
        for j in range(1, length + 1):
            ends = [i for i in range(max(0, j - pieces.longest), j) if (i, j) in found]
            most = logs[ends].max(axis=0)
            terms = [np.exp(logs[i] - most) * p[found[i, j], 0] for i in ends]
            total = np.maximum(sum(terms), 1e-290)
            logs[j] = most + np.log(total)
            share.update(((i, j), t / total) for i, t in zip(ends, terms))
        cut = np.zeros((length + 1, n))  # probability that a piece ends here
        cut[length] = weights[at]
        for j in range(length, 0, -1):
            for i in range(max(0, j - pieces.longest), j):
                if (i, j) in found:
                    used = share[i, j] * cut[j]
                    cut[i] += used
                    out += np.bincount(found[i, j], used, minlength=len(out))
    out[pieces.size] = 0
    return out


def letters(word: str) -> str:
    return word if word.isalpha() else "".join(filter(str.isalpha, word))


def _coded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(start of each text in words, code of each word, word of each code)."""
    starts, words = split_words(pc.utf8_lower(pc.fill_null(texts, "")))
    if not len(words):
        return starts, np.zeros(0, np.int64), []
    coded = pc.dictionary_encode(words)
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return starts, coded.indices.to_numpy(zero_copy_only=False), [letters(w) for w in coded.dictionary.to_pylist()]


def word_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, word, n) over whole texts whose language is known."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", 1 << 22):
                starts, codes, words = _coded(part.column(0))
                named = pc.dictionary_encode(part.column(1))
                of = np.repeat(named.indices.to_numpy(zero_copy_only=False), np.diff(starts)).astype(np.int64)
                key, n = np.unique(of * max(1, len(words)) + codes, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [named.dictionary.take(pa.array(key // max(1, len(words)))), pa.array(words, pa.string()).take(pa.array(key % max(1, len(words)))), pa.array(n, pa.int64())],
                    names=["lang", "word", "n"],
                )

    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    return known.mapInArrow(count, "lang string, word string, n long").where("word <> ''").groupBy("lang", "word").agg(F.sum("n").alias("n"))


class Model:
    """Languages in order, and per language the logarithm-free piece probabilities."""

    def __init__(self, langs: list[str], pieces: list[str], p: np.ndarray):
        self.langs, self.pieces, self.p = langs, pieces, p


def train(docs: DataFrame, text: str = "text", lang: str = "lang", vocabulary_path: str = VOCABULARY, rounds: int = 2, smoothing: float = 0.1, max_langs: int = 1000) -> Model:
    """Fit the piece probabilities of each language on the labelled ``docs``.

    All labelled texts count, in full, words of any length among them.  The model has languages x pieces numbers
    and is what the driver holds; more than ``max_langs`` languages raise.  No
    labelled text: a model without languages.
    """
    pieces = vocabulary(vocabulary_path)
    spark = docs.sparkSession
    counts = written(word_counts(docs, text, lang), "lang-words")
    langs = [r[0] for r in counts.select("lang").distinct().orderBy("lang").limit(max_langs + 1).collect()]
    if len(langs) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    p = np.full((len(pieces) + 2, len(langs)), 1.0 / (len(pieces) + 1))
    p[len(pieces)] = 0
    for _ in range(rounds if langs else 0):
        shared = spark.sparkContext.broadcast((langs, pieces, p))

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            langs, names, p = shared.value
            pieces, number = Pieces(names), {name: k for k, name in enumerate(langs)}
            total: dict[int, np.ndarray] = {}
            held: dict[int, tuple[list, list]] = {}

            def count(k: int) -> None:
                words, n = held.pop(k)
                total[k] = total.get(k, 0) + expected_counts(words, np.array(n, float), pieces, p[:, k : k + 1])

            for batch in batches:
                for name, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                    words, weights = held.setdefault(number[name], ([], []))
                    words.append(word)
                    weights.append(n)
                for k in [k for k, h in held.items() if len(h[0]) >= TRAINED_WORDS]:
                    count(k)
            for k in list(held):
                count(k)
            for k, got in total.items():
                at = np.flatnonzero(got > 1e-6)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)), pa.array(got[at])], names=["lang", "piece", "n"])

        sums = counts.mapInArrow(expect, "lang int, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
        got = np.zeros_like(p)
        got[sums["piece"], sums["lang"]] = sums["n"]
        got = np.round(got, 6) + smoothing
        got[len(pieces)] = 0
        p = got / got.sum(axis=0)
        shared.unpersist()
    return Model(langs, pieces, p)


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to the columns ``keep`` (all by default).

    ``lang_pred`` is the likeliest language; ``und``, with score 0, for a text
    that is null or has no letter, or if the model knows no language.  ``score``
    is the posterior of the language under equal priors.  Equal texts get equal
    results, ties go to the first language by code point.  Only the text is read;
    columns of the two new names are replaced.
    """
    keep = docs.columns if keep is None else keep
    n_keep = len(keep)
    out = hidden(docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`")))
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.pieces, model.p))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, names, p = shared.value
        pieces = Pieces(names)
        row: dict[str, int] = {}
        rows = np.zeros((CACHED_WORDS, max(1, len(langs))))
        for batch in batches:
            for part in text_slices(batch, f"c{n_keep}", 1 << 22):
                starts, codes, words = _coded(part.column(n_keep))
                if not langs:
                    codes, words, starts = codes[:0], [], np.zeros_like(starts)
                new = [w for w in dict.fromkeys(words) if w not in row]
                if len(row) + len(new) > CACHED_WORDS:
                    row, new = {}, list(dict.fromkeys(words))
                    if len(new) > len(rows):
                        rows = np.zeros((len(new), rows.shape[1]))
                if new:
                    ends = len(row) + len(new)
                    rows[len(row) : ends] = log_likelihoods(new, pieces, p)
                    row.update(zip(new, range(len(row), ends)))
                    if "" in row:
                        rows[row[""]] = 0
                at = np.array([row[w] for w in words], np.int64)
                seen = np.zeros(len(starts) - 1, bool)
                total = np.zeros((len(starts) - 1, rows.shape[1]))
                full = np.flatnonzero(np.diff(starts))
                if len(full):
                    lettered = np.array([w != "" for w in words])
                    seen[full] = np.logical_or.reduceat(lettered[codes], starts[full])
                    for k in range(rows.shape[1]):
                        total[full, k] = np.add.reduceat(rows[at, k][codes], starts[full])
                best = total.argmax(axis=1)
                sure = 1 / np.exp(total - total[np.arange(len(best)), best][:, None]).sum(axis=1)
                names_out = pa.array([langs[b] if s else UNDETERMINED for b, s in zip(best, seen)], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[:n_keep], names_out, pa.array(np.where(seen, sure, 0.0))], names=[*part.schema.names[:n_keep], "lang_pred", "score"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out.schema.fields[:n_keep])
    return shown(out.mapInArrow(label, f"{fields}, lang_pred string, score double"), keep, "lang_pred", "score")


def language_id(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", **options) -> DataFrame:
    """Predict every text's language from a model learnt on the documents not held out.

    Returns doc_id, held_out, lang_pred, score, a row per input row.  An empty
    table gives an empty result; rows with null lang are predicted, not learnt from.
    """
    held = is_held_out(doc_id)
    model = train(docs.where(~held), text, lang, **options)
    asked = docs.select(F.col(doc_id).alias("doc_id"), held.alias("held_out"), F.col(text).alias("text"))
    return predict(asked, model, "text", ["doc_id", "held_out"])


def keep_identified(docs: DataFrame, text: str = "text", min_score: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs`` whose language is determined with ``min_score`` or more, all columns kept."""
    model = train(docs.where(~is_held_out()), text, **options)
    rows = hidden(docs)
    kept = predict(rows, model, rows.columns[docs.columns.index(text)]).where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= min_score))
    return shown(kept, docs.columns)
