"""Language-model scores from subword lattices.

The pieces of an existing vocabulary weight every way to cut a word into pieces; the
probability of a word is the sum over all of them, found by the forward recursion in log
space, and a text is the product of its words and one end. Words begin with the mark
``▁`` as in the vocabulary; any byte can also be spelled by its byte piece, so every text
has a probability. Pieces start from the ranks in the vocabulary file and are weighted
by expectation maximisation over the counts of all training words. The weights of all
pieces and the end add up to one.

The corpus is gathered as one row per distinct word with its count, dealt out by word.
Words are scored there, many of one length at a time. Documents are scored in two parts:
frequent words, which make up at least one in ``HEAD_WORDS`` of all tokens each and are
therefore at most that many, are looked up in the workers; the others meet their scores
in a join dealt out by word, and sums come back per document.

Edge cases: a null text is an empty one and has the end alone; null ids belong to the
training part; rows with equal id and text score alike; without any training text all
pieces keep the weights of the vocabulary; an empty table gives an empty result; other
columns do not matter. A very long text is split in the memory of one worker. A very long
word is scored alone, in time in proportion to its length: about twenty seconds for each
million bytes, and as long in each round of maximisation, on the task that holds it.
"""

from __future__ import annotations

import math
import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curate.llm.common import keyed, stored
from curate.llm.tokenization import small_batches, vocabulary_path

PIECES = "piece_bpe_32k.model"
HEAD_WORDS = 200_000
ROUNDS = 2
PRIOR = 0.01
GROUP_BYTES = 8 << 20
BATCH_WORDS = 4096
#: Bytes of the words that are scored together, which bounds the forward table.
BATCH_BYTES = 1 << 20
#: Frequent words of more bytes are looked up by the join, which bounds the broadcast.
HEAD_LENGTH = 64

_MARK = "▁".encode()


_INSIDE, _BEGIN = 1, 2


class Lattice:
    """A byte trie over pieces and the forward and backward recursions on it.

    ``weights`` are natural logarithms, one for each of ``pieces``: first the 256 byte
    pieces, then the end, the bare mark, and the text pieces.
    """

    def __init__(self, texts: list[bytes], weights: np.ndarray):
        self.texts, self.weights = texts, weights
        self.longest = max((len(t.removeprefix(_MARK)) for t in texts), default=1)
        # No node, which no path leaves, and the roots inside a word and at its begin.
        nodes: list[dict[int, int]] = [{}, {}, {}]
        piece = [-1, -1, -1]
        for number, text in enumerate(texts):
            at = _INSIDE
            if text.startswith(_MARK):
                at, text = _BEGIN, text[len(_MARK):]
            for byte in text:
                if byte not in nodes[at]:
                    nodes[at][byte] = len(nodes)
                    nodes.append({})
                    piece.append(-1)
                at = nodes[at][byte]
            piece[at] = number
        self.next = np.zeros((len(nodes), 256), dtype=np.int32)  # 0: no such node
        for at, steps in enumerate(nodes):
            for byte, to in steps.items():
                self.next[at, byte] = to
        self.piece = np.array(piece, dtype=np.int64)
        self.reweigh(weights)

    def reweigh(self, weights: np.ndarray) -> None:
        self.weights = weights
        self.of_bytes, self.end, self.mark = weights[:256], weights[256], weights[257]
        own = np.append(weights[258:], -np.inf)
        self.of_node = own[self.piece]

    def _pieces(self, data: np.ndarray, start: int, root: int):
        """(end, rows, nodes) of the pieces that begin at ``start`` in the rows of ``data``."""
        rows, state = np.arange(len(data)), np.full(len(data), root, dtype=np.int64)
        for end in range(start + 1, min(start + self.longest, data.shape[1]) + 1):
            state = self.next[state, data[rows, end - 1]]
            alive = state > 0
            rows, state = rows[alive], state[alive]
            if not len(rows):
                return
            whole = self.piece[state] >= 0
            if whole.any():
                yield end, rows[whole], state[whole]

    def _forward(self, data: np.ndarray) -> np.ndarray:
        n, length = data.shape
        alpha = np.full((length + 1, n), -np.inf)
        alpha[0] = self.mark
        for start in range(length):
            if start == 0:
                for end, rows, nodes in self._pieces(data, 0, _BEGIN):
                    alpha[end, rows] = np.logaddexp(alpha[end, rows], self.of_node[nodes])
            for end, rows, nodes in self._pieces(data, start, _INSIDE):
                score = alpha[start, rows] + self.of_node[nodes]
                alpha[end, rows] = np.logaddexp(alpha[end, rows], score)
            spelled = alpha[start] + self.of_bytes[data[:, start]]
            alpha[start + 1] = np.logaddexp(alpha[start + 1], spelled)
        return alpha

    def scores(self, data: np.ndarray) -> np.ndarray:
        """Log probability of each row of bytes as a word."""
        return self._forward(data)[-1]

    def expected(self, data: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece, for words and their counts."""
        n, length = data.shape
        alpha, used = self._forward(data), np.zeros(len(self.weights))
        total = alpha[-1]
        beta = np.full((length + 1, n), -np.inf)
        beta[length] = 0.0

        def take(numbers: np.ndarray, log_share: np.ndarray) -> None:
            np.add.at(used, numbers, np.exp(log_share - total) * counts)

        for start in range(length - 1, -1, -1):
            byte = data[:, start]
            own = beta[start + 1] + self.of_bytes[byte]
            take(byte, alpha[start] + own)
            for root in (_INSIDE, _BEGIN) if start == 0 else (_INSIDE,):
                before = alpha[start] if root == _INSIDE else np.zeros(n)
                for end, rows, nodes in self._pieces(data, start, root):
                    path = self.of_node[nodes] + beta[end, rows]
                    np.add.at(
                        used, 258 + self.piece[nodes],
                        np.exp(before[rows] + path - total[rows]) * counts[rows],
                    )
                    if root == _INSIDE:
                        own[rows] = np.logaddexp(own[rows], path)
            beta[start] = own
        used[257] += float((np.exp(self.mark + beta[0] - total) * counts).sum())
        return used


def vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """Text pieces that can occur in lower-cased words, and first weights by their rank."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    texts, ranks = [], []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        text = model.id_to_piece(i).encode()
        body = text.removeprefix(_MARK)
        if body and _MARK not in body and body == body.lower() and len(body.split()) == 1:
            texts.append(text)
            ranks.append(-model.get_score(i))
    weights = 1.0 / (np.array(ranks) - min(ranks, default=0.0) + 10.0)
    rare = weights.min() / 10
    every = np.concatenate([np.full(256, rare), [weights.mean() * 10, weights.mean() * 10], weights])
    return texts, np.log(every / every.sum())


def _grouped(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and bytes of words of one length at a time."""
    by_length: dict[int, list[int]] = defaultdict(list)
    for i, word in enumerate(words):
        by_length[len(word)].append(i)
    for length, rows in by_length.items():
        together = max(1, min(BATCH_WORDS, BATCH_BYTES // max(1, length)))
        for at in range(0, len(rows), together):
            some = rows[at : at + together]
            joined = b"".join(words[i] for i in some)
            yield np.array(some), np.frombuffer(joined, dtype=np.uint8).reshape(-1, length)


def text_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in a row, with A-Z lower-cased, and where each text begins.

    Words are lower-cased once they are cut out, as ``ascii_lower`` takes wrong bytes from a
    slice of an array without nulls that was cast to 64-bit offsets.
    """
    split = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    words = split.flatten()
    real = pc.not_equal(words, "")
    ends = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    offsets = split.offsets.to_numpy()
    return pc.ascii_lower(words.filter(real)), ends[offsets - offsets[0]]


def held_out(key: Column) -> Column:
    """True for the tenth of the documents that is never learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 10 == 0, F.lit(False))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per group of texts, apart for the training part; Spark adds them up."""
    for batch in small_batches(batches, size=GROUP_BYTES):
        held = batch.column("held")
        for part, learned in ((batch.filter(pc.invert(held)), 1), (batch.filter(held), 0)):
            counts = text_words(part.column("text"))[0].value_counts()
            n = counts.field("counts")
            yield pa.RecordBatch.from_arrays(
                [counts.field("values").cast(pa.binary()), pc.multiply(n, learned), n],
                names=["word", "c", "everywhere"],
            )


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, c, everywhere): counts in the training part and in all documents."""
    slim = docs.select(F.col(text).alias("text"), held_out(F.col(key)).alias("held"))
    return (
        slim.mapInArrow(_count_words, "word binary, c long, everywhere long")
        .groupBy("word")
        .agg(F.sum("c").alias("c"), F.sum("everywhere").alias("everywhere"))
    )


def _expect(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    lattice, used = Lattice(*model.value), None
    for batch in batches:
        words, counts = batch.column("word").to_pylist(), batch.column("c").to_numpy()
        for rows, data in _grouped(words):
            mine = lattice.expected(data, counts[rows].astype(np.float64))
            used = mine if used is None else used + mine
    if used is not None:
        numbers = np.flatnonzero(used)
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int64()), pa.array(used[numbers])], names=["piece", "uses"]
        )


def train(words: DataFrame, texts: int, path: str, rounds: int = ROUNDS) -> tuple[list[bytes], np.ndarray]:
    """Piece texts and log weights after some rounds over all training words.

    What comes to the driver is one number per piece of the vocabulary file.
    """
    pieces, weights = vocabulary(path)
    context = words.sparkSession.sparkContext
    for _ in range(rounds if texts else 0):
        model = context.broadcast((pieces, weights))
        found = (
            words.filter(F.col("c") > 0)
            .select("word", "c")
            .mapInArrow(partial(_expect, model=model), "piece long, uses double")
            .groupBy("piece")
            .agg(F.sum("uses").alias("uses"))
            .toPandas()
        )
        uses = np.full(len(weights), PRIOR)
        np.add.at(uses, found["piece"].to_numpy(dtype=np.int64), found["uses"].to_numpy())
        uses[256] += texts
        weights = np.log(uses / uses.sum())
    return pieces, weights


def _score_words(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    lattice = Lattice(*model.value)
    for batch in batches:
        words = batch.column("word").to_pylist()
        scores = np.zeros(len(words))
        for rows, data in _grouped(words):
            scores[rows] = lattice.scores(data) / math.log(10)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(scores)], names=[*batch.schema.names, "score"]
        )


_HEADS: dict[str, dict[bytes, tuple[float, float, int]]] = {}


def _head(broadcast) -> dict[bytes, tuple[float, float, int]]:
    """The table of frequent words, built once per worker."""
    if broadcast.value["id"] not in _HEADS:
        _HEADS.clear()
        v = broadcast.value
        rows = zip(v["base"], v["score"], v["known"], strict=True)
        _HEADS[v["id"]] = dict(zip(v["words"], rows, strict=True))
    return _HEADS[broadcast.value["id"]]


def _score_documents(batches: Iterator[pa.RecordBatch], head) -> Iterator[pa.RecordBatch]:
    """For each row one line with the sums over frequent words, and one for each other
    distinct word with its number."""
    table, unknown = _head(head), (0.0, 0.0, 0)
    for batch in small_batches(batches):
        flat, begins = text_words(batch.column("text"))
        lengths = np.diff(begins)
        coded = flat.dictionary_encode()
        codes, distinct = coded.indices.to_numpy(), coded.dictionary.cast(pa.binary())
        hits = [table.get(w) for w in distinct.to_pylist()]
        frequent = np.array([h is not None for h in hits], dtype=bool)[codes]
        values = np.array([h or unknown for h in hits], dtype=float).reshape(-1, 3)
        row = np.repeat(np.arange(len(batch)), lengths)
        of, found = row[frequent], values[codes[frequent]]
        base, score, known = (np.bincount(of, found[:, i], len(batch)) for i in range(3))
        pair, times = np.unique(row[~frequent] * max(1, len(distinct)) + codes[~frequent], return_counts=True)
        in_row, word = np.divmod(pair, max(1, len(distinct)))
        taken = pa.array(np.concatenate([np.arange(len(batch)), in_row]))
        rare = len(pair)
        yield pa.RecordBatch.from_arrays(
            [
                # The sums alone need the key as it came.
                pa.concat_arrays([batch.column("key"), pa.nulls(rare, batch.column("key").type)]),
                *[batch.column(c).take(taken) for c in ("__id", "__th")],
                pa.concat_arrays([pa.nulls(len(batch), pa.binary()), distinct.take(pa.array(word))]),
                pa.array(np.concatenate([lengths, times]).astype(np.int64)),
                *[
                    pa.concat_arrays([pa.array(v.astype(t)), pa.nulls(rare, pa.from_numpy_dtype(t))])
                    for v, t in ((base, np.float64), (score, np.float64), (known, np.int64))
                ],
            ],
            names=["key", "__id", "__th", "word", "n", "base", "score", "known"],
        )


def score_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", pieces: str | None = None,
    head_words: int = HEAD_WORDS, rounds: int = ROUNDS,
) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score), one row for
    each row of ``docs``; scores are log10 probabilities."""
    spark = docs.sparkSession
    counts = stored(word_counts(docs, key, text), "words")
    seen = counts.agg(
        F.sum("c").alias("c"), F.sum((F.col("c") > 0).cast("long")).alias("v"),
        F.sum("everywhere").alias("all"),
    ).first()
    texts = docs.filter(~held_out(F.col(key))).count()
    tokens = int(seen["c"] or 0) + texts
    distinct = int(seen["v"] or 0) + (1 if texts else 0)
    spread = tokens + 0.1 * (distinct + 1)
    model = train(counts, texts, pieces or vocabulary_path(PIECES), rounds)
    shared = spark.sparkContext.broadcast(model)
    base = F.log10((F.col("c") + 0.1) / F.lit(spread))
    table = stored(
        counts.mapInArrow(
            partial(_score_words, model=shared), "word binary, c long, everywhere long, score double"
        ).select(
            "word", "everywhere", "score", base.alias("base"),
            (F.col("c") > 0).cast("long").alias("known"),
        ),
        "scored",
    )
    # At most head_words words can each be one in head_words of all tokens.
    least = max(1.0, int(seen["all"] or 0) / head_words)
    often = (F.col("everywhere") >= least) & (F.octet_length("word") <= HEAD_LENGTH)
    frequent = table.filter(often).toArrow().to_pydict()
    head = spark.sparkContext.broadcast(
        {"id": uuid.uuid4().hex, "words": frequent["word"]}
        | {c: frequent[c] for c in ("base", "score", "known")}
    )
    named = keyed(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "key")
    kind = docs.schema[key].dataType.simpleString()
    lines = named.mapInArrow(
        partial(_score_documents, head=head),
        f"key {kind}, __id {kind}, __th long, word binary, n long, base double, score double, known long",
    )
    lines = stored(lines, "lines")
    rare = (
        lines.filter(F.col("word").isNotNull())
        .select("key", "__id", "__th", "word", "n")  # the key is null here
        .join(table.select("word", *[F.col(c).alias(f"w_{c}") for c in ("base", "score", "known")]), "word")
        .select(
            "key", "__id", "__th", F.lit(0).cast("long").alias("n"),
            *[(F.col("n") * F.col(f"w_{c}")).alias(c) for c in ("base", "score", "known")],
            F.lit(0).alias("rows"),
        )
    )
    whole = lines.filter(F.col("word").isNull()).select(
        "key", "__id", "__th", "n", "base", "score", "known", F.lit(1).alias("rows")
    )
    # Rows with equal id and text are summed together, divided, and given out again.
    sums = (
        whole.unionByName(rare)
        .groupBy("__id", "__th")
        .agg(
            F.max("key").alias(key), F.sum("rows").cast("int").alias("rows"),
            *[F.sum(c).alias(c) for c in ("n", "base", "score", "known")],
        )
    )
    end = math.log10(((texts or 0) + 0.1) / spread)
    end_score = float(model[1][256]) / math.log(10)
    return sums.withColumn("__row", F.explode(F.sequence(F.lit(1), F.col("rows")))).select(
        key,
        held_out(F.col(key)).alias("held_out"),
        (F.expr("n div rows") + 1).alias("n_tokens"),
        (F.expr("known div rows") + (1 if texts else 0)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("rows") + end).alias("base_score"),
        (F.col("score") / F.col("rows") + end_score).alias("score"),
    )
