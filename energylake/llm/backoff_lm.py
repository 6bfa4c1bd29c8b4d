"""Language-model scores by a weighted backoff automaton over smoothed n-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema as schema_of

from energylake.llm.common import pick

ORDER, PRIOR, ADD = 2, 30.0, 0.1
BLOCK_BYTES, PART_BYTES, LEAST_PARTS = 4 << 20, 16 << 20, 8  # small tables are dealt out, too
BEGIN, END = b" begin", b" end"  # words hold no space, so these are none
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
ONE = np.uint64(1)


def words(text: str | None) -> list[bytes]:
    """Stretches without ASCII white space, A-Z in lower case."""
    return (text or "").encode().lower().split()


class Grams:
    """The n-grams of some texts, numbered per length in the order of first sight.

    Length 1 numbers the words, 0 is the mark before a text and 1 the one after it.  ``at[n]``
    holds the number of the n-gram that ends at each position, -1 where the text is too short,
    and for each n-gram ``context[n]`` the n-gram without its last word, ``shorter[n]`` the one
    without its first, ``last[n]`` its last word and ``key[n]`` its 64-bit key.  Keys of words
    are odd, all others even.
    """

    def __init__(self, texts: list[str | None], order: int):
        number = {BEGIN: 0, END: 1}
        flat, sizes = [], []
        for text in texts:
            own = words(text)
            flat.append(0)
            flat += [number.setdefault(w, len(number)) for w in own]
            flat.append(1)
            sizes.append(len(own) + 2)
        flat = np.array(flat, np.int64)
        self.order, self.width, self.sizes = order, len(number), np.array(sizes, np.int64)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        hashed = np.array([xxhash.xxh3_64_intdigest(w) for w in number], np.uint64)
        self.at, self.key = {1: flat}, {1: hashed | ONE}
        self.key[1][0] &= ~ONE  # the opening mark is a context, never a token
        self.context, self.shorter, self.last = {}, {}, {1: np.arange(len(number))}
        for n in range(2, order + 1):
            ends = np.flatnonzero(place >= n - 1)
            before, word = self.at[n - 1][ends - 1], flat[ends]
            _, first, own = np.unique(before * self.width + word, return_index=True, return_inverse=True)
            self.at[n] = np.full(len(flat), -1)
            self.at[n][ends] = own
            self.context[n], self.last[n] = before[first], word[first]
            self.shorter[n] = self.at[n - 1][ends[first]]
            z = (self.key[n - 1][before[first]] ^ np.uint64(n)) * MULTIPLIER[0] + hashed[word[first]]
            z = (z ^ (z >> np.uint64(32))) * MULTIPLIER[1]
            self.key[n] = (z ^ (z >> np.uint64(29))) & ~ONE

    def counts(self, learn: np.ndarray) -> np.ndarray:
        """Occurrences of every n-gram in the texts to learn from, lengths one after the other."""
        kept = np.repeat(learn, self.sizes)
        return np.concatenate([np.bincount(self.at[n][kept & (self.at[n] >= 0)], minlength=len(self.key[n]))
                               for n in range(1, self.order + 1)])

    def ordered(self) -> tuple[np.ndarray, np.ndarray]:
        """All keys in rising order, and the order."""
        keys = np.concatenate([self.key[n] for n in range(1, self.order + 1)])
        order = np.argsort(keys, kind="stable")
        return keys[order], order


class Automaton:
    """The model's part that some texts can reach: states, arcs and failure arcs.

    A state is an n-gram seen in training that is shorter than the order, or the root.  An
    n-gram seen in training is an arc from its context over its last word, and leads to the
    longest of its own suffixes that is a state.  Where a state has no arc for a word, its
    failure arc leads to the state without the first word.  With c counts and a prior m,
    p(w | h) = (c(h w) + m p(w | h without its first word)) / (c(h) + m), so an arc weighs
    log p(w | h), the failure arc of h log(m / (c(h) + m)), and the weights of a path sum up to
    the log-probability.  At the root, p(w) = (c(w) + add) / (tokens + add * (kinds + 1)).

    ``weight[n]`` and ``cost[n]`` hold the weights of the arc and of the failure arc of each n-gram by its
    number, NaN where there is no such arc.
    """

    def __init__(self, grams: Grams, counts: np.ndarray, tokens: int, kinds: int, prior: float, add: float):
        lengths = range(1, grams.order + 1)
        count = dict(zip(lengths, np.split(counts, np.cumsum([len(grams.key[n]) for n in lengths])[:-1])))
        chance = (np.where(np.arange(grams.width) > 0, count[1], 0) + add) / (tokens + add * (kinds + 1))
        self.order, self.known, self.base = grams.order, count[1] > 0, np.log10(chance)
        self.state = self.known.tolist()
        self.weight, self.cost = {1: self.base.tolist()}, {}
        for n in lengths[1:]:
            chance = (count[n] + prior * chance[grams.shorter[n]]) / (count[n - 1][grams.context[n]] + prior)
            self.weight[n] = np.where(count[n] > 0, np.log10(chance), np.nan).tolist()
            self.cost[n - 1] = np.log10(prior / (count[n - 1] + prior)).tolist()

    def walk(self, at: dict[int, list[int]]) -> float:
        """Log10-probability of a text, whose n-grams of each length are given by position.

        The state after a word is the n-gram of length ``held`` that ends there, so it needs no more
        than that length; the arc over the next word is the n-gram one longer that ends at it.
        """
        weight, cost, state, most = self.weight, self.cost, self.state, self.order - 1
        words, total = at[1], 0.0
        held = 1 if most and state[words[0]] else 0
        for i in range(1, len(words)):
            n = held + 1
            arc = weight[n][at[n][i]]
            while arc != arc:
                n -= 1
                total += cost[n][at[n][i - 1]]
                arc = weight[n][at[n][i]]
            total += arc
            held = min(n, most) if n > 1 or state[words[i]] else 0
        return total


def narrow(counts: np.ndarray) -> bytes:
    """Counts in a byte each; those of 255 and more follow in full."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype(np.int64).tobytes()


def widened(data: bytes, n: int) -> np.ndarray:
    """The ``n`` counts of ``narrow``."""
    counts = np.frombuffer(data, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, np.uint8, offset=n).copy().view(np.int64)
    return counts


def score_texts(docs: DataFrame, learn: Column, order: int = ORDER, prior: float = PRIOR, add: float = ADD,
                block_bytes: int = BLOCK_BYTES, part_bytes: int = PART_BYTES,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words of the whole text and one mark after it; a null text is an empty one.
    The model learns n-grams up to ``order`` from the rows for which the condition ``learn`` on
    the column ``id`` holds, and gives every row its log10-probability as ``score``;
    ``base_score`` is that of the model of order 1.  ``n_known`` counts tokens seen in training.
    Repeated rows are learned and scored each for itself.  Without rows to learn from, every
    token counts as unknown; an empty table gives no rows.

    The model grows with the texts and no task holds it whole.  Rows are dealt to blocks of
    about ``block_bytes`` by a hash of their content.  Each block sends its distinct n-grams,
    with their counts, to the parts of the key space; a part adds the counts of all blocks
    and answers each with the sums of its own n-grams.  From these a block builds the
    states and arcs its texts can reach, and walks through them.  Any n-gram is sent
    once a block at most, so a frequent one burdens no part.  Keys are 64-bit hashes: of 10^9
    n-grams, the chance that any two share a key is about 3 %, of 10^8 0.03 %.
    """
    rows = pick(docs, id=id_col, text=text_col)
    size = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 1
    blocks, parts = (max(LEAST_PARTS, -(-size // n)) for n in (block_bytes, part_bytes))
    block = F.pmod(F.xxhash64(F.col("id").cast("string"), "text"), F.lit(blocks)).cast("int")
    rows = rows.select(block.alias("block"), "id", "text", F.coalesce(learn, F.lit(False)).alias("learn"))
    rows = rows.repartition(blocks, "block")

    def cuts(keys: np.ndarray) -> np.ndarray:
        """Where each part's stretch of the sorted keys begins, and the end."""
        borders = (np.arange(1, parts, dtype=object) * 2 ** 64 // parts).astype(np.uint64)
        return np.concatenate([[0], np.searchsorted(keys, borders), [len(keys)]])

    def ask(table: pa.Table) -> pa.Table:
        grams = Grams(table.column("text").to_pylist(), order)
        keys, at = grams.ordered()
        counts, cut = grams.counts(table.column("learn").to_numpy())[at], cuts(keys)
        del grams, at
        return pa.Table.from_pydict({
            "block": pa.array(np.full(parts, table.column("block")[0].as_py(), np.int32)),
            "part": pa.array(np.arange(parts, dtype=np.int32)),
            "keys": pa.array([keys[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
            "counts": pa.array([narrow(counts[a:b]) for a, b in zip(cut, cut[1:])], pa.binary())})

    def add_up(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(b, np.uint64) for b in table.column("keys").to_pylist()]
        ends = np.cumsum([len(k) for k in keys])[:-1]
        distinct, own = np.unique(np.concatenate(keys), return_inverse=True)
        counts = np.concatenate([widened(b, len(k)) for b, k in zip(table.column("counts").to_pylist(), keys)])
        total = np.bincount(own, counts, len(distinct)).astype(np.int64)
        tokens = total[(distinct & ONE) == ONE]
        return pa.Table.from_pydict({
            "block": table.column("block"), "part": table.column("part"),
            "counts": pa.array([narrow(c) for c in np.split(total[own], ends)], pa.binary()),
            "tokens": pa.array(np.full(len(keys), tokens.sum())),
            "kinds": pa.array(np.full(len(keys), np.count_nonzero(tokens)))})

    def walk(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return arrow.empty_table()
        grams = Grams(table.column("text").to_pylist(), order)
        keys, at = grams.ordered()
        counts, cut = np.empty(len(at), np.int64), cuts(keys)
        parted = answers.sort_by("part").column("counts").to_pylist()
        counts[at] = np.concatenate([widened(c, b - a) for c, a, b in zip(parted, cut, cut[1:])])
        tokens, kinds = (int(np.sum(answers.column(c).to_numpy())) for c in ("tokens", "kinds"))
        model = Automaton(grams, counts, tokens, kinds, prior, add)
        ends = np.cumsum(grams.sizes)
        spans = list(zip((ends - grams.sizes).tolist(), ends.tolist()))
        tokens_of = [grams.at[1][a + 1:b] for a, b in spans]
        paths = ({n: own[a:b].tolist() for n, own in grams.at.items()} for a, b in spans)
        return pa.Table.from_arrays([
            table.column("id"), pa.array(grams.sizes - 1),
            pa.array([int(model.known[t].sum()) for t in tokens_of], pa.int64()),
            pa.array(np.full(len(spans), tokens)),
            pa.array([float(model.base[t].sum()) for t in tokens_of], pa.float64()),
            pa.array([model.walk(p) for p in paths], pa.float64())], schema=arrow)

    fields = [T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")]
    fields += [T.StructField(n, T.DoubleType()) for n in ("base_score", "score")]
    schema = T.StructType([T.StructField("doc_id", rows.schema["id"].dataType), *fields])
    arrow = schema_of(schema)
    asked = rows.groupBy("block").applyInArrow(ask, "block int, part int, keys binary, counts binary")
    answers = asked.repartition(parts, "part").groupBy("part").applyInArrow(
        add_up, "block int, part int, counts binary, tokens long, kinds long")
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(walk, schema)
