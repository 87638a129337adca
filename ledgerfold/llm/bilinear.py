"""Log-bilinear language model, trained by noise-contrastive estimation, and its scores of texts.

Words are counted over all training texts. The ``HEAD`` most frequent are symbols of their own; every
other word belongs to a class, its last three bytes: the ``CLASSES`` most frequent endings, and one for
the rest. The model predicts the next symbol: vectors of the ``CONTEXT`` symbols before it, weighted
by place, add up to one vector, whose product with a symbol's vector, plus a bias, is its logit. A
word of a class then has the share (c+1) / (tokens + words + 1) of it; an unknown word has c = 0. So the
probabilities of a place add up to one over known words and one unknown word of each class.

Training meets every training text once, in rounds over growing shares of them. In a round each
task goes on from the same parameters with its own texts, batch by batch: the next symbols
against ``NOISE`` symbols drawn from the frequencies. The parameters, some ten thousand numbers
whatever the corpus, are averaged over tasks by their tokens. Scoring uses full sums over all symbols.

Tasks know the counts of words with at least one in ``CACHED`` of all tokens, so at most that many; a
text's other words leave the task as (word, count) and meet the table of counts in a join.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from itertools import chain, repeat

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.common import small_batches, text_bytes
from ledgerfold.sources.scratch import written

HEAD, CLASSES, CACHED = 192, 191, 2_000_000
CONTEXT, WIDTH, NOISE = 4, 16, 40
BATCH, SCORED, RATE, SEED = 1024, 128, 0.08, 7
ROUNDS = ((0, 1), (1, 4), (4, 16))  # sixteenths of the training texts
WORDS = 1 << 18
END = b"\n"  # no word can be this


def tokens_of(text: bytes) -> list[bytes]:
    """Stretches without ASCII white space, A-Z lower-cased, and the end."""
    words = text.lower().split()
    words.append(END)
    return words


def is_held_out(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2


def blocks(batches, column: int):
    """(rows, tokens of each row) of about ``WORDS`` tokens."""
    rows, words, held = [], [], 0
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for k, text in enumerate(columns[column]):
            rows.append([c[k] for i, c in enumerate(columns) if i != column])
            words.append(tokens_of(text))
            held += len(words[-1])
            if held >= WORDS:
                yield rows, words
                rows, words, held = [], [], 0
    if rows:
        yield rows, words


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over ``texts.text``: combined in the task, then by word."""

    def run(batches):
        import pyarrow as pa

        for _, words in blocks(batches, 0):
            seen = Counter()
            for w in words:
                seen.update(w)
            yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], ["word", "c"])

    return texts.select("text").mapInArrow(run, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """What tasks know of the words; of bounded size."""

    tokens: int
    words: int
    cached: dict[bytes, int]  # word: place in the arrays below
    count: np.ndarray
    symbol: np.ndarray
    endings: dict[bytes, int]  # ending: symbol
    share: np.ndarray  # log10 of 1 / (tokens + words + 1) of a class, 0 for a symbol that is one word
    frequency: np.ndarray  # of the symbols

    def symbols(self, words: list[list[bytes]]):
        """(symbol, place in the cache or -1) of all tokens, one text after another."""
        total = sum(map(len, words))
        place = np.fromiter(map(self.cached.get, chain.from_iterable(words), repeat(-1)), np.int64, total)
        out = self.symbol[place]
        missing = np.flatnonzero(place < 0)
        if len(missing):
            flat = list(chain.from_iterable(words))
            rest = len(self.share) - 1
            out[missing] = [self.endings.get(flat[i][-3:], rest) for i in missing.tolist()]
        return out, place


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From the written table of counts. The driver gets the words of at least one in CACHED tokens, which
    are at most CACHED, CLASSES endings and sums."""
    whole = counts.agg(F.sum("c").alias("c"), F.count("*").alias("v")).first()
    tokens = whole.c or 0
    first = sorted(counts.where(F.col("c") * CACHED >= tokens).collect(), key=lambda r: (-r.c, r.word))
    heads = first[:HEAD]
    least = (heads[-1].c, bytes(heads[-1].word)) if heads else (0, b"")
    # the words after the last head in the same order
    tail = counts.where((F.col("c") < least[0]) | ((F.col("c") == least[0]) & (F.col("word") > F.lit(least[1]))))
    ending = F.expr("substring(word, greatest(octet_length(word) - 2, 1), 3)")
    by_ending = written(tail.groupBy(ending.alias("ending")).agg(F.sum("c").alias("c"), F.count("*").alias("v")), "endings")
    classes = by_ending.orderBy(F.col("c").desc(), "ending").limit(CLASSES).collect()
    rest = [tokens - sum(r.c for r in [*heads, *classes]), whole.v - len(heads) - sum(r.v for r in classes)]
    endings = {bytes(r.ending): len(heads) + i for i, r in enumerate(classes)}
    sizes = [(r.c, r.v) for r in classes] + [tuple(rest)]
    last = len(heads) + len(classes)
    symbol = np.array([i if i < len(heads) else endings.get(bytes(r.word)[-3:], last) for i, r in enumerate(first)] + [0], np.int64)
    share = np.concatenate([np.zeros(len(heads)), [-np.log10(c + v + 1) for c, v in sizes]])
    return Vocabulary(
        tokens, whole.v, {bytes(r.word): i for i, r in enumerate(first)},
        np.array([r.c for r in first] + [0], np.int64), symbol, endings, share,
        np.array([r.c for r in heads] + [c + 1 for c, _ in sizes], float))


def scatter(index: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sums of the rows by index."""
    width = rows.shape[1]
    return np.bincount((index[:, None] * width + np.arange(width)).ravel(), rows.ravel(), size * width).reshape(size, width)


@dataclass
class Model:
    """Vectors of context symbols (the last for a place before the text), of predicted symbols with
    their biases, and weights of the context's places."""

    given: np.ndarray
    wanted: np.ndarray
    bias: np.ndarray
    places: np.ndarray
    seen: list = field(default_factory=list)  # sums of squared gradients of a round

    @classmethod
    def fresh(cls, frequency: np.ndarray):
        rng, n = np.random.default_rng(SEED), len(frequency)
        parts = [rng.normal(0, 0.1, (n + 1, WIDTH)), rng.normal(0, 0.1, (n, WIDTH)), np.log(frequency / frequency.sum()), np.ones((CONTEXT, WIDTH))]
        return cls(*[p.astype(np.float32) for p in parts])

    def parts(self):
        return [self.given, self.wanted, self.bias, self.places]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def with_values(self, flat: np.ndarray):
        cuts = np.cumsum([p.size for p in self.parts()])[:-1]
        return Model(*[x.reshape(p.shape).astype(np.float32) for x, p in zip(np.split(flat, cuts), self.parts())])

    def contexts(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The symbols before each token, nearest first."""
        at = np.arange(len(symbols))
        offset = at - np.repeat(np.cumsum(sizes) - sizes, sizes)
        back = np.arange(1, CONTEXT + 1)
        return np.where(offset[:, None] >= back, symbols[np.maximum(at[:, None] - back, 0)], len(self.bias))

    def train(self, symbols: np.ndarray, sizes: np.ndarray, frequency: np.ndarray, rng) -> None:
        """One pass over the tokens of a block, in random order of batches."""
        noise = frequency / frequency.sum()
        level, steps = np.log(NOISE * noise).astype(np.float32), np.cumsum(noise)
        context, place = self.contexts(symbols, sizes), np.arange(CONTEXT) * len(self.given)
        if not self.seen:
            self.seen = [np.full(p.shape, 1e-3, np.float32) for p in self.parts()]
        for at in rng.permutation(np.arange(0, len(symbols), BATCH)):
            before, target = context[at:at + BATCH], symbols[at:at + BATCH]
            drawn = np.minimum(np.searchsorted(steps, rng.random(NOISE)), len(steps) - 1)
            weighed = (self.places[:, None] * self.given).reshape(-1, WIDTH)  # of each place and symbol
            guess = weighed[before + place].sum(axis=1)
            right, wrong = self.wanted[target], self.wanted[drawn]
            up = 1 / (1 + np.exp(np.clip((guess * right).sum(axis=1) + self.bias[target] - level[target], -30, 30)))
            down = -1 / (1 + np.exp(-np.clip(guess @ wrong.T + (self.bias - level)[drawn], -30, 30)))
            slope = up[:, None] * right + down @ wrong
            by_place = np.stack([scatter(before[:, k], slope, len(self.given)) for k in range(CONTEXT)])
            index = np.concatenate([target, drawn])
            gradients = [
                (by_place * self.places[:, None]).sum(axis=0),
                scatter(index, np.concatenate([up[:, None] * guess, down.T @ guess]), len(self.wanted)),
                np.bincount(index, np.concatenate([up, down.sum(axis=0)]), len(self.bias)),
                (by_place * self.given).sum(axis=1)]
            for part, seen, g in zip(self.parts(), self.seen, gradients):
                g = g.astype(np.float32)
                seen += g * g
                part += RATE * g / np.sqrt(seen)

    def log10_of(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Normalised log10 probability of each token's symbol."""
        context, out = self.contexts(symbols, sizes), np.empty(len(symbols))
        guess = np.ones((len(symbols), WIDTH + 1), np.float32)
        guess[:, :-1] = (self.given * self.places[0])[context[:, 0]]
        for k in range(1, CONTEXT):
            guess[:, :-1] += (self.given * self.places[k])[context[:, k]]
        table = np.ascontiguousarray(np.column_stack([self.wanted, self.bias]).T)  # the bias belongs to a constant one
        one = np.ones(len(self.bias), np.float32)
        reach = np.sqrt((guess[:, :-1] ** 2).sum(axis=1).max(initial=0) * (self.wanted ** 2).sum(axis=1).max())
        wide = reach + np.abs(self.bias).max() > 80  # else no exponential is out of range
        for at in range(0, len(symbols), SCORED):
            target = symbols[at:at + SCORED]
            logit = guess[at:at + SCORED] @ table
            if wide:
                logit -= logit.max(axis=1, keepdims=True)
            mine = logit[np.arange(len(target)), target]
            out[at:at + SCORED] = mine - np.log(np.exp(logit, out=logit) @ one)
        return out / np.log(10)


def fit(texts: DataFrame, vocab: Vocabulary) -> Model:
    """A model from all rows of ``texts`` (doc_id, text)."""
    model = Model.fresh(vocab.frequency)
    share = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(16))
    for low, high in ROUNDS:

        def run(batches, start=model):
            import pyarrow as pa
            from pyspark import TaskContext

            mine, rng, tokens = start.with_values(start.flat()), np.random.default_rng([SEED, TaskContext.get().partitionId()]), 0
            for _, words in blocks(batches, 0):
                symbols, _ = vocab.symbols(words)
                mine.train(symbols, np.array([len(w) for w in words]), vocab.frequency, rng)
                tokens += len(symbols)
            if tokens:
                values = mine.flat()
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values.astype(float) * tokens), pa.array(np.full(len(values), tokens))],
                                                 ["i", "v", "n"])

        slim = texts.where((share >= low) & (share < high)).select("text")
        rows = slim.mapInArrow(run, "i bigint, v double, n bigint").groupBy("i").agg((F.sum("v") / F.sum("n")).alias("v")).collect()
        if rows:
            values = np.empty(len(rows))
            values[[r.i for r in rows]] = [r.v for r in rows]
            model = model.with_values(values)
    return model


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row.

    Counts and the model come from the rows that are not held out; a null id is neither held out
    nor learned from (held_out null). A null text is empty and has one token, its end; texts of any
    length are scored whole; repeated rows count and are scored one by one. Without any training
    row all tokens are unknown and both scores are 0. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), is_held_out(id_col).alias("held_out"), text_bytes(text_col).alias("text"))
    texts = slim.where(~F.col("held_out"))
    counts = written(word_counts(texts), "word-counts")
    vocab = vocabulary(counts)
    model = fit(texts, vocab)
    base = -float(np.log10(vocab.tokens + vocab.words + 1))

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        key = TaskContext.get().partitionId() << 40
        logs = np.log10(vocab.count + 1.0)
        known = (vocab.count > 0).astype(np.int64)
        for rows, words in blocks(batches, 2):
            sizes = np.array([len(w) for w in words], np.int64)
            begins = np.cumsum(sizes) - sizes
            symbols, place = vocab.symbols(words)
            more = logs[place]  # the last place stands for words that are not cached: zero
            # a word that is a symbol of its own has no share of a class
            single = symbols < len(vocab.share) - len(vocab.endings) - 1
            score = model.log10_of(symbols, sizes) + np.where(single, 0, more + vocab.share[symbols]) if vocab.tokens else np.zeros(len(symbols))
            rare, many = [], []
            missing = np.flatnonzero(place < 0)
            for k, at in enumerate(np.split(missing, np.searchsorted(missing, begins[1:]))):
                seen = Counter([words[k][i] for i in (at - begins[k]).tolist()])
                rare.append(list(seen.keys()))
                many.append(list(seen.values()))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(key, key + len(rows))), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.bool_()),
                pa.array(sizes), pa.array(np.add.reduceat(known[place], begins)), pa.array(np.add.reduceat(more + base, begins)),
                pa.array(np.add.reduceat(score, begins)), pa.array(rare, pa.list_(pa.binary())), pa.array(many, pa.list_(pa.int64()))],
                ["key", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rare", "many"])
            key += len(rows)

    partly = written(slim.mapInArrow(run, "key bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, "
                                          "score double, rare array<binary>, many array<bigint>"), "partly-scored")
    words = partly.select("key", F.explode(F.arrays_zip("rare", "many")).alias("w")).select("key", F.col("w.rare").alias("word"), F.col("w.many").alias("many"))
    found = words.join(counts, "word").groupBy("key").agg(
        F.sum("many").alias("known"), F.sum(F.col("many") * F.log10(F.col("c") + F.lit(1.0))).alias("more"))
    extra = F.coalesce("more", F.lit(0.0))
    return partly.drop("rare", "many").join(found, "key", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(vocab.tokens).cast("bigint").alias("train_tokens"), (F.col("base_score") + extra).alias("base_score"),
        (F.col("score") + extra).alias("score"))
