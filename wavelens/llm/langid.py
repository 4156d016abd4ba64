"""Language of documents by a linear-chain conditional random field over their words.

Every word of a line gets a language, so that code-switched text is told apart, and
neighbouring words support each other by learned transitions. A word's own evidence is a
sum of learned weights: of its character n-grams with its borders marked (prefixes and
suffixes are the n-grams that hold a border), of the word itself, and of its standing in
the lexicon of each language. Posteriors come from the forward-backward algorithm, run
over all lines of a slice in step. A document's language is the one with the largest sum
of posteriors over its words, its score their mean.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavelens.llm.common import arrow_map, slices

UNKNOWN = "und"
#: Documents per language that a model is fitted on at most, and word runs of each.
FIT_DOCUMENTS = 400
FIT_RUNS = 5
RUN_WORDS = 24
#: Share of training runs made of two languages.
SWITCHED = 0.3
#: Slots of the hash that training documents are drawn by, as a power of two.
HASH_BITS = 40
FEATURES = 1 << 16
NGRAMS = (1, 2, 3, 4)
EPOCHS = 5
#: Words a worker remembers the evidence of.
REMEMBERED = 150_000
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def letters(word: str) -> str:
    """The letters of a word in lower case."""
    return word.lower() if word.isalpha() else "".join(c for c in word.lower() if c.isalpha())


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams and identities of words (letters only): feature ids and row starts."""
    text = "".join([f"\x02{w}\x03" for w in words])
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words])
    begin = np.cumsum(sizes) - sizes
    word_of = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(begin + sizes, sizes) - np.arange(len(code))  # characters to the word's end
    rows, ids = [], []
    h = np.zeros(len(code), np.uint64)
    for n in range(1, max(NGRAMS) + 1):
        ahead = np.zeros(len(code), np.uint64)
        ahead[: len(code) - n + 1] = code[n - 1 :]
        h = (h ^ ahead) * _MULTIPLIER + np.uint64(n)
        fits = left >= n
        rows.append(word_of[fits])
        ids.append((h[fits] ^ (h[fits] >> np.uint64(29))) * _MULTIPLIER >> np.uint64(48))
    rows.append(np.arange(len(words)))
    ids.append(np.array([zlib.crc32(w.encode()) % FEATURES for w in words], np.uint64))
    row, feature = np.concatenate(rows), np.concatenate(ids).astype(np.int64)
    order = np.argsort(row, kind="stable")
    starts = np.searchsorted(row[order], np.arange(len(words)))
    return feature[order], starts


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # [FEATURES, K]
    lexical: np.ndarray  # [K, K]: weight of standing in lexicon k
    transitions: np.ndarray  # [K, K]
    lexicon: dict[str, int]
    known: dict[str, int] = field(default_factory=dict)
    table: np.ndarray | None = None

    def __getstate__(self):
        return {**self.__dict__, "known": {}, "table": None}

    def evidence(self, words: list[str]) -> np.ndarray:
        """Scores ``[words, K]`` of words given by their letters; none has no evidence."""
        out = np.zeros((len(words), len(self.languages)), np.float32)
        if not words:
            return out
        feature, starts = features(words)
        counts = np.diff(np.append(starts, len(feature)))[:, None]
        out += np.add.reduceat(self.weights[feature], starts, axis=0) / np.sqrt(counts)
        for i, w in enumerate(words):
            if (k := self.lexicon.get(w)) is not None:
                out[i] += self.lexical[k]
        return out

    def lookup(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of each word in the table of evidence (-1 without a letter), and the table."""
        if len(self.known) > REMEMBERED:
            self.known, self.table = {}, None
        known = self.known
        new = [w for w in dict.fromkeys(words) if w not in known]
        if new:
            spelled = [letters(w) for w in new]
            used = 0 if self.table is None else len(self.table)
            fresh = [w for w in spelled if w]
            number = iter(range(used, used + len(fresh)))
            known.update((w, next(number) if s else -1) for w, s in zip(new, spelled, strict=True))
            parts = [self.evidence(fresh[i : i + 20_000]) for i in range(0, len(fresh), 20_000)]
            self.table = np.concatenate([*([] if self.table is None else [self.table]), *parts]) if parts else self.table
        if self.table is None:
            self.table = np.zeros((0, len(self.languages)), np.float32)
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words)), self.table


def forward_backward(evidence: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Posteriors ``[n, K]`` of chains laid end to end, all chains one step at a time."""
    _, ahead, back = messages(evidence, lengths, transitions)
    ahead *= back
    return ahead / ahead.sum(axis=1, keepdims=True)


def pair_posteriors(evidence: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors of words, and ``[m, K, K]`` of words with their next one in the chain."""
    local, ahead, back = messages(evidence, lengths, transitions)
    post = ahead * back
    here = np.ones(len(local), bool)
    here[np.cumsum(lengths) - 1] = False
    here = np.flatnonzero(here)
    pair = ahead[here, :, None] * np.exp(transitions)[None] * (local * back)[here + 1, None, :]
    return post / post.sum(axis=1, keepdims=True), pair / pair.sum(axis=(1, 2), keepdims=True)


def messages(evidence: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Local factors of all words, and what comes to each from before (itself included) and after.

    Each is scaled freely per word.
    """
    k = evidence.shape[1]
    local = np.exp(evidence - evidence.max(axis=1, keepdims=True))
    step = np.exp(transitions).astype(evidence.dtype)
    order = np.argsort(-lengths, kind="stable")
    start = (np.cumsum(lengths) - lengths)[order]
    size = lengths[order]
    active = len(size) - np.searchsorted(size[::-1], np.arange(1, (size[0] if len(size) else 0) + 1))
    ahead = np.empty_like(local)
    state = np.full((len(size), k), 1.0 / k, local.dtype)
    for t, n in enumerate(active):
        at = start[:n] + t
        state = local[at] * (state[:n] @ step if t else state[:n])
        state /= state.sum(axis=1, keepdims=True)
        ahead[at] = state
    back = np.ones((len(size), k), local.dtype)
    behind = np.empty_like(local)
    end = start + size - 1
    for t, n in enumerate(active):
        at = end[:n] - t
        if t:
            back = (local[at + 1] * back[:n]) @ step.T
            back /= back.sum(axis=1, keepdims=True)
        behind[at] = back[:n]
    return local, ahead, behind


def chains(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """All words, the lines' numbers of words, and the document of each line."""
    words: list[str] = []
    lengths, owner = [], []
    for i, text in enumerate(texts):
        for line in (text or "").split("\n"):
            if found := line.split():
                words += found
                lengths.append(len(found))
                owner.append(i)
    return words, np.array(lengths, np.int64), np.array(owner, np.int64)


def posteriors(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words with a letter, their posteriors, and the document each belongs to."""
    words, lengths, owner = chains(texts)
    number, table = model.lookup(words)
    spelled = number >= 0
    line = np.repeat(np.arange(len(lengths)), lengths)[spelled]
    lengths = np.bincount(line, minlength=len(lengths))
    if not len(line) or not model.languages:
        return [], np.zeros((0, len(model.languages))), np.zeros(0, np.int64)
    found = forward_backward(table[number[spelled]], lengths[lengths > 0], model.transitions)
    return [w for w, s in zip(words, spelled, strict=True) if s], found, owner[line]


def hash_limit(n: int, documents: int) -> int:
    """How far up the slots of a hash to draw about ``2 * documents`` of ``n``; never none."""
    return max(1, min(1 << HASH_BITS, (2 * documents << HASH_BITS) // n))


def training_runs(docs: DataFrame, documents: int = FIT_DOCUMENTS) -> list[tuple[str, list[str]]]:
    """Word runs with their language, from at most ``documents`` documents per language.

    ``docs`` is ``(key, text, lang)`` with no null ``lang``. Documents are taken by the
    hash of their key; per document, runs are spread evenly over the whole text. The
    sample does not grow with the corpus.
    """
    counts = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    order = F.xxhash64(F.col("key").cast("string"))
    # a few numbers per language decide in the scan which texts move at all
    limits = F.create_map(*[F.lit(x) for c, n in counts.items() for x in (c, hash_limit(n, documents))])
    drawn = docs.filter(F.pmod(order, F.lit(1 << HASH_BITS)) < F.element_at(limits, F.col("lang")))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(order, "key"))
    rows = drawn.withColumn("rank", rank).filter(F.col("rank") <= documents)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = [s for w in (text or "").split() if (s := letters(w))]
                runs = [words[i : i + RUN_WORDS] for i in range(0, len(words), RUN_WORDS)]
                picked = np.unique(np.linspace(0, len(runs) - 1, min(FIT_RUNS, len(runs))).astype(int))
                out += [(lang, " ".join(runs[i])) for i in picked]
            a, b = zip(*out, strict=True) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], ["lang", "words"])

    found = arrow_map(rows.select("lang", "text"), run, "lang string, words string").collect()
    return sorted((r["lang"], r["words"].split(" ")) for r in found if r["words"])


def code_switched(runs: list[tuple[str, list[str]]], index: dict[str, int]) -> list[tuple[list[str], list[int]]]:
    """Training chains; some get their second part from a run of another language."""
    rng = np.random.default_rng(7)
    out = []
    for lang, words in runs:
        tags = [index[lang]] * len(words)
        if len(index) > 1 and rng.random() < SWITCHED:
            other, more = runs[rng.integers(len(runs))]
            cut = int(rng.integers(1, len(words) + 1))
            words, tags = words[:cut] + more[cut:], tags[:cut] + [index[other]] * len(more[cut:])
        out.append((words, tags))
    return [out[i] for i in rng.permutation(len(out))]


def fit(runs: list[tuple[str, list[str]]], epochs: int = EPOCHS, batch: int = 192) -> Model:
    """Maximum likelihood of the chains' labels by adaptive gradient steps."""
    languages = sorted({lang for lang, _ in runs})
    index = {lang: i for i, lang in enumerate(languages)}
    k = len(languages)
    seen: dict[str, Counter] = {}
    for lang, words in runs:
        for w in words:
            seen.setdefault(w, Counter())[index[lang]] += 1
    lexicon = {
        w: c.most_common(1)[0][0] for w, c in seen.items()
        if sum(c.values()) >= 3 and c.most_common(1)[0][1] >= 0.8 * sum(c.values())
    }
    model = Model(languages, np.zeros((FEATURES, k), np.float32), np.zeros((k, k), np.float32), np.zeros((k, k), np.float32), lexicon)
    data = code_switched(runs, index)
    squares = [np.full_like(x, 1e-3) for x in (model.weights, model.lexical, model.transitions)]
    for epoch in range(epochs):
        for i in range(0, len(data), batch):
            _step(model, data[i : i + batch], squares, 0.3 / (1 + epoch))
    return model


def _scores(model: Model, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Scores ``[n, K]`` of words, with their features, the numbers of these, and their lexicon."""
    feature, starts = features(words)
    counts = np.diff(np.append(starts, len(feature)))
    scores = np.add.reduceat(model.weights[feature].astype(np.float64), starts, axis=0) / np.sqrt(counts)[:, None]
    lexical = np.array([model.lexicon.get(w, -1) for w in words])
    scores[lexical >= 0] += model.lexical[lexical[lexical >= 0]]
    return scores, feature, counts, lexical


def gradients(model: Model, chunk: list[tuple[list[str], list[int]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slopes of the log-likelihood of labelled chains by weights, lexical weights and transitions.

    Each is what was seen less what the model expects: words by their posteriors,
    neighbours by those of pairs.
    """
    words = [w for ws, _ in chunk for w in ws]
    tags = np.array([t for _, ts in chunk for t in ts])
    lengths = np.array([len(ws) for ws, _ in chunk])
    k, n = len(model.languages), len(words)
    scores, feature, counts, lexical = _scores(model, words)
    post, pair = pair_posteriors(scores, lengths, model.transitions.astype(np.float64))
    gap = -post
    gap[np.arange(n), tags] += 1
    inner = np.ones(n, bool)
    inner[np.cumsum(lengths) - 1] = False
    here = np.flatnonzero(inner)
    moves = -pair.sum(0)
    np.add.at(moves, (tags[here], tags[here + 1]), 1)
    rows = np.repeat(np.arange(n), counts)
    flow = gap / np.sqrt(counts)[:, None]
    slope = np.stack([np.bincount(feature, flow[rows, c], FEATURES) for c in range(k)], axis=1)
    lex = np.zeros((k, k))
    np.add.at(lex, lexical[lexical >= 0], gap[lexical >= 0])
    return slope, lex, moves


def _step(model: Model, chunk: list[tuple[list[str], list[int]]], squares: list[np.ndarray], rate: float) -> None:
    for value, grad, square in zip((model.weights, model.lexical, model.transitions), gradients(model, chunk), squares, strict=True):
        grad = grad / len(chunk) - 1e-5 * value
        square += grad**2
        value += (rate * grad / np.sqrt(square)).astype(np.float32)


def predict(
    docs: DataFrame, model: Model, keep: Sequence[str], text: str = "text", lang: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``lang`` and ``score``, from ``text`` alone.

    A text that is null or has no letter is ``und`` with score 0. Of equal sums, the
    language that comes first by name wins. ``keep`` must not hold the added names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = list(keep)
    rows = docs.select(*keep, *([] if text in keep else [F.col(text).cast("string")]))
    at = rows.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for batch in batches:
            for part in slices(batch, text):
                _, post, owner = posteriors(model, part.column(at).to_pylist())
                n, k = part.num_rows, len(model.languages)
                total = np.stack([np.bincount(owner, post[:, c], n) for c in range(k)], axis=1) if k else np.zeros((n, 1))
                words = np.bincount(owner, minlength=n)
                best = np.where(words > 0, total.argmax(axis=1), k)
                share = np.where(words > 0, total.max(axis=1) / np.maximum(words, 1), 0.0)
                added = [pa.array(names[best], pa.string()), pa.array(np.clip(share, 0, 1))]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *added], [*keep, lang, score])

    fields = T.StructType([T.StructField(c, rows.schema[c].dataType) for c in keep])
    return arrow_map(rows, run, fields.add(lang, T.StringType()).add(score, T.DoubleType()))


def word_labels(docs: DataFrame, model: Model) -> DataFrame:
    """``(key, words, langs)``: every word with a letter, in order, and its language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["key"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(shared.value.languages, dtype=object)
        for batch in batches:
            for part in slices(batch, "text"):
                words, post, owner = posteriors(shared.value, part.column(1).to_pylist())
                langs = names[post.argmax(axis=1)] if len(words) else []
                ends = np.searchsorted(owner, np.arange(part.num_rows + 1))
                offsets = pa.array(ends.astype(np.int32))
                columns = [pa.ListArray.from_arrays(offsets, pa.array(list(x), pa.string())) for x in (words, langs)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["key", "words", "langs"])

    rows = docs.select("key", F.col("text").cast("string").alias("text"))
    return arrow_map(rows, run, f"key {kind}, words array<string>, langs array<string>")


def held_out(key: str = "doc_id"):
    """Whether a document is kept from training; a null key is not, but is never trained on."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def trained(docs: DataFrame) -> Model:
    """A model from the documents of ``(doc_id, text, lang)`` that training may see."""
    seen = docs.filter(F.col("lang").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
    return fit(training_runs(seen.select(F.col("doc_id").alias("key"), "text", "lang")))
