"""Language-model scores from a hidden Markov model over words.

Counts: every training word is counted (combined in the tasks, then by one shuffle). The
most frequent words, at most ``CLASS_WORDS``, and the end token form a bounded dictionary that goes
to every task. All other training words are rows of a table; nothing gathers them.

Blocks: texts are encoded once in blocks of about ``BLOCK_TOKENS`` tokens, training and
held-out texts apart. A block numbers its own words outside the dictionary, and one
shuffled join finds them among the training words.

Model: states emit words, and every training word has expected counts of its own in every
state. Baum-Welch runs over all training texts: a round joins each block with the weights
of its words, and the expected counts are summed by word in Spark. Up to ``2 ** TEAM_BITS``
neighbouring blocks are a team, whose blocks are gone through one after another and whose
counts leave together. The sums of the dictionary's words, the starts and the transitions leave a
team packed, are added up in groups of ``FAN_IN`` teams until few are left, and go to the driver; those of
all other words stay a table that the next round joins. A word that training has only once
has nothing to sum, so its counts stay with its block. Words unseen in training share the
smoothing mass of ``RARE_CLASSES`` words, so any text has a probability.

Score: the scaled forward recursion gives the exact likelihood of the words and the end,
for many documents side by side and over their whole length.

Defined cases: null and empty texts are one end token; a null id is trained on; with no
training text every word is unseen, and the model stays uniform; repeated rows each get a
row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .quality import held_out
from .shared import full_text
from .shared import written as kept

CLASS_WORDS = 250_000
RARE_CLASSES = 64
STATES = 6
ROUNDS = 3
SMOOTH = 0.1
STAY = 0.95  # first guess: a state lasts, so that documents part by language and register first
SEED = 11
COUNTER_WORDS = 400_000
SLICE_ROWS = 1024
BLOCK_TOKENS = 1 << 19
TEAM_BITS = 2
FAN_IN = 16
FEW_SUMS = 4  # sums of packed counts that the driver adds up itself
ONCE = -(1 << 62)  # word number of the row that holds a block's single words


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _tidy(spark: SparkSession) -> Iterator[None]:
    """What a query shuffles is deleted as soon as it ends, so that rounds do not pile up on the disks."""
    conf = spark.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """A written table, well compressed; what its making shuffled is deleted at once."""
    with _tidy(df.sparkSession):
        return kept(df, label, compression="zstd")


def forget(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _pack(numbers: np.ndarray) -> bytes:
    """Four-byte numbers for disks and shuffles: their count, then their bytes by place, since equal places pack well, compressed."""
    planes = np.ascontiguousarray(numbers).reshape(-1, 1).view(np.uint8).T.tobytes()
    return np.array(numbers.size, dtype="<u4").tobytes() + pa.compress(planes, codec="zstd", asbytes=True)


def _unpack(packed: bytes, kind: str) -> np.ndarray:
    size = int(np.frombuffer(packed, dtype="<u4", count=1)[0])
    if not size:
        return np.empty(0, dtype=kind)
    planes = np.frombuffer(pa.decompress(packed[4:], 4 * size, codec="zstd", asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(4, size).T).view(kind).ravel()


def tokens(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.encode().lower().split()


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    bag: Counter[bytes] = Counter()
    ends = 0
    for batch in batches:
        ends += len(batch)
        for text in batch["text"]:
            bag.update(tokens(text))
            if len(bag) > COUNTER_WORDS:  # the counter's memory stays bounded; Spark adds the parts up
                yield pd.DataFrame({"word": list(bag.keys()), "n": list(bag.values())})
                bag = Counter()
    yield pd.DataFrame({"word": [*bag.keys(), None], "n": [*bag.values(), ends]})


def word_counts(texts: DataFrame) -> DataFrame:
    """word (null: the end token), n: counts over all training texts."""
    return written(texts.select("text").mapInPandas(_count_words, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")).filter("n > 0"), "word-counts")


def _dictionary_bound(counts: DataFrame, most: int) -> int:
    """The least count of a dictionary word: the ``most`` words of the largest counts, less those of a step that would exceed it.

    Counts are looked at in steps of an eighth of an octave, single up to 8, so few numbers return.
    """
    step = F.when(F.col("n") < 8, F.col("n") - 8).otherwise(F.floor(F.log2("n") * 8))
    steps = counts.filter("word is not null").groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("n")).collect()
    held, bound = 0, 1 << 62
    for row in sorted(steps, key=lambda r: -r["n"]):
        held += row["words"]
        if held > most:
            break
        bound = row["n"]
    return bound


class _Block:
    """Texts as numbers: dictionary words, the end token, then the block's other words in order of first use."""

    def __init__(self, held: bool) -> None:
        self.held, self.others, self.ids, self.lengths, self.codes, self.open, self.size = held, {}, [], [], [], [], 0

    def add(self, doc_id: str | None, text: str, known: dict[bytes, int]) -> None:
        end, others = len(known), self.others
        words = tokens(text)
        self.open.extend([k if (k := known.get(w, -1)) >= 0 else others.setdefault(w, end + 1 + len(others)) for w in words])
        self.open.append(end)
        self.ids.append(doc_id)
        self.lengths.append(len(words) + 1)
        self.size += len(words) + 1
        if len(self.ids) % SLICE_ROWS == 0:  # numbers of a slice go into an array before the next one
            self.pack()

    def pack(self) -> None:
        self.codes.append(np.array(self.open, dtype="<i4"))
        self.open = []

    def row(self, end: int) -> pd.DataFrame:
        self.pack()
        codes = _pack(np.concatenate(self.codes).astype("<i4"))
        return pd.DataFrame({"held_out": [self.held], "ids": [self.ids], "lengths": [self.lengths], "codes": [codes], "words": [list(self.others)]})


def _encode(frequent: dict[bytes, int]):
    known = {w: k for k, w in enumerate(frequent)}

    def of_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filled = {held: _Block(held) for held in (False, True)}
        for batch in batches:
            for doc_id, held, text in zip(batch["doc_id"], batch["held_out"], batch["text"], strict=True):
                block = filled[bool(held)]
                block.add(doc_id, text, known)
                if block.size >= BLOCK_TOKENS:
                    yield block.row(len(known))
                    filled[block.held] = _Block(block.held)
        for block in filled.values():
            if block.ids:
                yield block.row(len(known))

    return of_partition


def _sequences(block: pd.DataFrame) -> list[np.ndarray]:
    """The code sequences of a block's texts."""
    lengths = np.asarray(block["lengths"].iloc[0])
    return np.split(_unpack(block["codes"].iloc[0], "<i4"), np.cumsum(lengths)[:-1])


class Model:
    """Start, transition and emission probabilities."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        self.start, self.move, self.emit = start, move, np.ascontiguousarray(emit)  # emit: classes x states

    def _aligned(self, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(order, classes, offsets): texts longest first, their classes step by step.

        At step t the texts still running are the first ones, and their classes are
        ``classes[offsets[t]:offsets[t + 1]]``.
        """
        lengths = np.array([len(s) for s in sequences])
        order = np.argsort(-lengths, kind="stable")
        lengths = lengths[order]
        running = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # texts longer than t
        offsets = np.concatenate([[0], np.cumsum(running)])
        text = np.repeat(np.arange(len(order)), lengths)
        step = np.arange(len(text)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        classes = np.empty(len(text), dtype=np.int64)
        classes[offsets[step] + text] = np.concatenate([sequences[i] for i in order])
        return order, classes, offsets

    def forward(self, sequences: list[np.ndarray]) -> np.ndarray:
        """log10 likelihood of each class sequence by the scaled forward recursion."""
        order, classes, offsets = self._aligned(sequences)
        total = np.zeros(len(order))
        alpha = None
        for low, high in zip(offsets.tolist(), offsets[1:].tolist(), strict=False):
            live = high - low
            alpha = (self.start[None, :] if alpha is None else alpha[:live] @ self.move) * self.emit[classes[low:high]]
            scale = alpha.sum(axis=1)
            alpha /= scale[:, None]
            total[:live] += np.log10(scale)
        out = np.empty(len(order))
        out[order] = total
        return out

    def expected(self, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected start, transition and emission counts (forward-backward) of some sequences."""
        order, classes, offsets = self._aligned(sequences)
        states, steps = len(self.start), list(zip(offsets.tolist(), offsets[1:].tolist(), strict=False))
        onward = self.move.astype(np.float32)
        back = np.ascontiguousarray(onward.T)
        emitted = self.emit.astype(np.float32)[classes]
        alphas, scales = np.empty((len(classes), states), np.float32), np.empty((len(classes), 1), np.float32)
        before = None
        for low, high in steps:
            alpha = alphas[low:high]
            if before is None:
                np.multiply(emitted[low:high], self.start.astype(np.float32), out=alpha)
            else:
                np.matmul(before[:high - low], onward, out=alpha)
                alpha *= emitted[low:high]
            scale = scales[low:high]
            np.sum(alpha, axis=1, keepdims=True, out=scale)
            alpha /= scale
            before = alpha
        emitted /= scales
        move = np.zeros((states, states))
        beta = np.ones((len(order), states), np.float32)
        seen = alphas  # turned into state probabilities from the last step to the first
        for (low, high), (_, end) in zip(steps[-2::-1], steps[::-1], strict=False):
            on = end - high  # texts that run on at the next step
            weighed = emitted[high:end] * beta[:on]
            move += alphas[low:low + on].T @ weighed
            seen[high:end] *= beta[:on]
            np.matmul(weighed, back, out=beta[:on])
        seen[:offsets[1]] *= beta
        emit = np.stack([np.bincount(classes, seen[:, k], minlength=len(self.emit)) for k in range(states)], axis=1)
        return seen[:offsets[1]].sum(axis=0).astype(float), move * self.move, emit


def _chunks(sequences: list[np.ndarray], most: int = 1 << 19) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Row numbers and sequences in groups of bounded length in all, similar lengths together.

    A group takes as many steps as its longest text has tokens, so long texts should not
    make short ones wait.
    """
    rows, length = [], 0
    for i in sorted(range(len(sequences)), key=lambda k: -len(sequences[k])):
        if rows and length + len(sequences[i]) > most:
            yield rows, [sequences[k] for k in rows]
            rows, length = [], 0
        rows.append(i)
        length += len(sequences[i])
    if rows:
        yield rows, [sequences[k] for k in rows]


class Weights:
    """What a round sends to every task, and the tables of all other words' emission weights.

    Sent: starts, transitions, the dictionary's emission weights, the states' totals.
    ``words``: (word_no, w0, w1, ...) of words that training has several times. ``once``:
    per training block the places and weights of the words that training has only there.
    Both are None before the first round, when counts alone give the weights.
    """

    def __init__(self, start: np.ndarray, move: np.ndarray, frequent: np.ndarray, total: np.ndarray, words: DataFrame | None = None, once: DataFrame | None = None) -> None:
        self.sent, self.words, self.once = (start, move, frequent, total), words, once


def _columns(states: int) -> list[str]:
    return [f"w{k}" for k in range(states)]


def _first(states: int) -> list:
    """First weights of words outside the dictionary: their counts, tilted per state by the word's hash."""
    tilt = [F.pmod(F.xxhash64("tilt", F.lit(k)), F.lit(1 << 20)) / (1 << 20) + 0.5 for k in range(states)]
    return [((F.col("n") + SMOOTH) * t).cast("float").alias(c) for t, c in zip(tilt, _columns(states), strict=True)]


def _sum(words: DataFrame, states: int) -> np.ndarray:
    return np.array([x or 0.0 for x in words.agg(*[F.sum(F.col(c).cast("double")) for c in _columns(states)]).first()])


def _once(block: pd.DataFrame, states: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights of the words that training has only once, in this block."""
    if "once_at" not in block or not isinstance(block["once_at"].iloc[0], bytes):
        return np.empty(0, np.int32), np.empty((0, states), np.float32)
    return _unpack(block["once_at"].iloc[0], "<i4"), _unpack(block["once"].iloc[0], "<f4").reshape(-1, states)


def _block_model(sent: tuple[np.ndarray, ...], block: pd.DataFrame, words: pd.DataFrame) -> Model:
    """The model over a block's codes; words that training has not seen keep the smoothing weight."""
    start, move, frequent, total = sent
    others = np.full((int(block["n_words"].iloc[0]), len(start)), SMOOTH)
    others[words["at"].to_numpy(dtype=np.int64)] = words[_columns(len(start))].to_numpy()
    at, weights = _once(block, len(start))
    others[at] = weights
    return Model(start, move, np.concatenate([frequent, others]) / total)


def _team(blocks: DataFrame) -> DataFrame:
    """Blocks are numbered one after another within a partition, so neighbours share all but the last bits."""
    return blocks.withColumn("team", F.shiftright("block", TEAM_BITS))


def _members(rows: pd.DataFrame, words: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, pd.DataFrame]]:
    """A team's blocks in order, each with the weights of its single words in its row, and its other words."""
    standing = rows["codes"].notna()
    blocks = rows[standing].sort_values("block")
    if "once_at" in rows:
        blocks = blocks.drop(columns=["once_at", "once"]).merge(rows.loc[~standing, ["block", "once_at", "once"]], on="block", how="left")
    theirs = dict(iter(words.groupby("block")))
    for i in range(len(blocks)):
        block = blocks.iloc[[i]]
        yield block, theirs.get(block["block"].iloc[0], words[:0])


def _expectations(sent: tuple[np.ndarray, ...]):
    """Expected counts of a team: one row for each of its words that others may have too, and one row for each block.

    A block's row holds the counts of the words that stand once. The first one also holds
    what the team adds up: the counts of the dictionary's words it met, of its starts and
    transitions, and of all words that stand once (numbered after the dictionary).
    """
    own, states = len(sent[2]), len(sent[0])

    def of_team(rows: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        few = np.zeros((own + 2 + states, states))
        numbers, counts, singles = [], [], []
        for block, theirs in _members(rows, words):
            model = _block_model(sent, block, theirs)
            emit = np.zeros_like(model.emit)
            for _, group in _chunks(_sequences(block)):
                s, m, e = model.expected(group)
                few[own] += s
                few[own + 1:-1] += m
                emit += e
            few[:own] += emit[:own]
            others = emit[own:]
            single = theirs["n"].to_numpy() == 1
            at = np.sort(np.concatenate([_once(block, states)[0], theirs["at"].to_numpy(dtype=np.int32)[single]]))
            once, shared = (others[at] + SMOOTH).astype("<f4"), theirs[~single]
            few[-1] += once.sum(axis=0, dtype=float)
            singles.append((int(block["block"].iloc[0]), _pack(at.astype("<i4")), _pack(once)))
            numbers.append(shared["word_no"].to_numpy(dtype=np.int64))
            counts.append(others[shared["at"].to_numpy(dtype=np.int64)])
        number, which = np.unique(np.concatenate(numbers), return_inverse=True)
        counts = np.concatenate(counts)
        met = np.flatnonzero(few.any(axis=1))
        none, blank = [None] * len(number), np.zeros(len(singles), np.float32)
        return pd.DataFrame({
            "word_no": np.concatenate([np.full(len(singles), ONCE), number]),
            **{c: np.concatenate([blank, np.bincount(which, counts[:, k], minlength=len(number)).astype(np.float32)]) for k, c in enumerate(_columns(states))},
            "block": [*[b for b, _, _ in singles], *none], "once_at": [*[x for _, x, _ in singles], *none], "once": [*[x for _, _, x in singles], *none],
            "few_at": [_pack(met.astype("<i4")), *[None] * (len(singles) - 1), *none],
            "few": [_pack(few[met].astype("<f4")), *[None] * (len(singles) - 1), *none]}).astype({"block": "Int64"})

    return of_team


def _added(rows: pd.DataFrame, size: int, states: int) -> np.ndarray:
    """Sum of packed counts."""
    total = np.zeros((size, states))
    for at, counts in zip(rows["few_at"], rows["few"], strict=True):
        total[_unpack(at, "<i4")] += _unpack(counts, "<f4").reshape(-1, states)
    return total


def _few_counts(parts: DataFrame, size: int, states: int) -> np.ndarray:
    """Counts of the dictionary's words, starts and transitions over all teams, added in groups of about ``FAN_IN``."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = _added(rows, size, states)
        met = np.flatnonzero(total.any(axis=1))
        return pd.DataFrame({"number": [int(rows["group"].iloc[0])], "few_at": [_pack(met.astype("<i4"))], "few": [_pack(total[met].astype("<f4"))]})

    rows = parts.filter("few IS NOT NULL").select(F.pmod(F.xxhash64("block"), F.lit(1 << 40)).alias("number"), "few_at", "few")
    left = rows.count()
    while left > FEW_SUMS:
        left = max(-(-left // FAN_IN), FEW_SUMS)
        rows = rows.withColumn("group", (F.col("number") % left).cast("bigint")).groupBy("group").applyInPandas(add, "number bigint, few_at binary, few binary")
    with _tidy(parts.sparkSession):
        return _added(rows.select("few_at", "few").toPandas(), size, states)  # at most FEW_SUMS rows


def baum_welch(blocks: DataFrame, placed: DataFrame, weights: Weights, rounds: int, unseen_words: int) -> Weights:
    """Rounds over all training blocks. What returns to the driver is at most ``FEW_SUMS`` sums over dictionary words and states."""
    own, states = len(weights.sent[2]), len(weights.sent[0])
    columns = _columns(states)
    schema = "word_no bigint, " + ", ".join(f"{c} float" for c in columns) + ", block bigint, once_at binary, once binary, few_at binary, few binary"
    before: list[DataFrame] = []
    for _ in range(rounds):
        if weights.words is None:
            held, theirs = blocks, placed.select("block", "at", "word_no", "n", *_first(states))
        else:
            held = blocks.unionByName(weights.once, allowMissingColumns=True)
            theirs = placed.filter("n > 1").join(weights.words, "word_no").select("block", "at", "word_no", "n", *columns)
        parts = written(_team(held).groupBy("team").cogroup(_team(theirs).groupBy("team")).applyInPandas(_expectations(weights.sent), schema), "team-counts")
        table = _few_counts(parts, own + 2 + states, states)
        once = table[-1].copy()
        table += SMOOTH
        start, move = table[own], table[own + 1:-1]
        sums = parts.filter("word_no >= 0").groupBy("word_no").agg(*[F.sum(c).cast("float").alias(c) for c in columns])
        words = written(sums.select("word_no", *[(F.col(c) + SMOOTH).cast("float").alias(c) for c in columns]), "expected-counts")
        total = table[:own].sum(axis=0) + _sum(words, states) + once + SMOOTH * unseen_words
        single = written(parts.filter(f"word_no = {ONCE}").select("block", "once_at", "once"), "once-counts")
        weights = Weights(start / start.sum(), move / move.sum(axis=1, keepdims=True), table[:own], total, words, single)
        # These tables are durable, so nothing needs what they were made from, not even a lost executor's tasks.
        forget(parts, *before)
        before = [words, single]
    return weights


def _first_weights(counts: np.ndarray, rare: DataFrame, states: int, unseen_words: int) -> Weights:
    """Word frequencies, tilted per state by seeded noise, so that states can part."""
    noise = np.random.default_rng(SEED).uniform(0.5, 1.5, (len(counts), states))
    move = np.full((states, states), (1 - STAY) / states) + np.eye(states) * STAY
    frequent = (counts[:, None] + SMOOTH) * noise
    return Weights(np.full(states, 1 / states), move, frequent, frequent.sum(axis=0) + _sum(rare.select(*_first(states)), states) + SMOOTH * unseen_words)


def _lent(states: int):
    """Weights of a training block's single words for the held-out blocks that have them too."""

    def of_block(block: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        at, weights = _once(block, states)
        found = weights[np.searchsorted(at, wanted["there"].to_numpy())] if len(wanted) else weights[:0]
        return pd.DataFrame({"block": wanted["block"], "at": wanted["at"], "n": 1, **{c: found[:, k] for k, c in enumerate(_columns(states))}})

    return of_block


def _final_words(placed: DataFrame, weights: Weights, states: int) -> DataFrame:
    """block, at, n, weights: what blocks do not hold themselves, for scoring."""
    columns = ["block", "at", "n", *_columns(states)]
    if weights.words is None:
        return placed.select("block", "at", "n", *_first(states))
    shared = placed.filter("n > 1").join(weights.words, "word_no").select(*columns)
    single = placed.filter("n = 1")
    home = single.filter("not held_out").select("word_no", F.col("block").alias("home"), F.col("at").alias("there"))
    wanted = single.filter("held_out").select("word_no", "block", "at").join(home, "word_no").select("home", "there", "block", "at")
    schema = "block bigint, at int, n bigint, " + ", ".join(f"{c} float" for c in columns[3:])
    return shared.unionByName(weights.once.withColumnRenamed("block", "home").groupBy("home").cogroup(wanted.groupBy("home")).applyInPandas(_lent(states), schema))


def _scores(sent: tuple[np.ndarray, ...], known: np.ndarray):
    """One row per text of a block: its likelihood, and its words' part of the base score."""

    def of_block(block: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        model, sequences = _block_model(sent, block, words), _sequences(block)
        others = np.zeros(int(block["n_words"].iloc[0]), dtype=np.int64)
        others[words["at"].to_numpy(dtype=np.int64)] = words["n"].to_numpy()
        others[_once(block, len(sent[0]))[0]] = 1
        times = np.concatenate([known, others])
        gains, score = np.log10(times + 1), np.zeros(len(sequences))
        for rows, group in _chunks(sequences):
            score[rows] = model.forward(group)
        return pd.DataFrame({
            "doc_id": list(block["ids"].iloc[0]), "held_out": bool(block["held_out"].iloc[0]), "n_tokens": [len(s) for s in sequences],
            "n_known": [int((times[s] > 0).sum()) for s in sequences], "gain": [float(gains[s].sum()) for s in sequences], "score": score})

    return of_block


def lm_scores(docs: DataFrame, fold_of: int = 7, fold: int = 2, class_words: int = CLASS_WORDS, rare_classes: int = RARE_CLASSES,
              states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    texts = docs.select("doc_id", held_out(fold_of, fold).alias("held_out"), full_text().alias("text"))
    counts = word_counts(texts.filter("not held_out"))
    all_tokens, distinct, ends = counts.agg(F.sum("n"), F.count(F.lit(1)), F.sum(F.when(F.col("word").isNull(), F.col("n")))).first()
    all_tokens, ends = all_tokens or 0, ends or 0
    least_n = _dictionary_bound(counts, class_words)
    top = counts.filter("word is not null").filter(F.col("n") >= least_n).toArrow().sort_by([("n", "descending"), ("word", "ascending")])  # at most class_words
    frequent = dict(zip(top["word"].to_pylist(), top["n"].to_pylist(), strict=True))
    del top
    known_count = np.array([*frequent.values(), ends], dtype=np.int64)
    least = np.log10(all_tokens + distinct + 1)

    # The id passes through pandas as text, which keeps large and null ones as they are.
    blocks = texts.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(
        _encode(frequent), "held_out boolean, ids array<string>, lengths array<int>, codes binary, words array<binary>")
    blocks = written(blocks.withColumn("block", F.monotonically_increasing_id()), "word-blocks")

    rare = counts.filter("word is not null").filter(F.col("n") < least_n)
    rare = written(rare.select("word", "n", F.monotonically_increasing_id().alias("word_no"), F.pmod(F.xxhash64("word", F.lit(SEED)), F.lit(1 << 16)).cast("int").alias("tilt")), "rare-words")
    met = blocks.select("block", "held_out", F.posexplode("words").alias("at", "word"))
    placed = written(met.join(rare, "word").select("block", "held_out", "at", "word_no", "n", "tilt"), "placed-words")
    blocks = blocks.withColumn("n_words", F.size("words")).drop("words")

    weights = _first_weights(known_count.astype(float), rare, states, rare_classes)
    forget(counts, rare)
    if all_tokens:
        trained = blocks.filter("not held_out").select("block", "lengths", "codes", "n_words")
        weights = baum_welch(trained, placed.filter("not held_out"), weights, rounds, rare_classes)

    held = blocks if weights.once is None else blocks.join(weights.once, "block", "left")
    scored = held.groupBy("block").cogroup(_final_words(placed, weights, states).groupBy("block")).applyInPandas(
        _scores(weights.sent, known_count), "doc_id string, held_out boolean, n_tokens bigint, n_known bigint, gain double, score double")
    return scored.select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType), "held_out", "n_tokens", "n_known", F.lit(int(all_tokens)).cast("bigint").alias("train_tokens"),
        (F.col("gain") - F.col("n_tokens") * F.lit(float(least))).alias("base_score"), "score")
