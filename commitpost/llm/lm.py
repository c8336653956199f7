"""Language-model scores: a small causal self-attention model over subword ids, and smoothed word counts.

Tokens are the words of the lower-cased text and one end. The word counts give the base score, in one exact sum: the
``HEAD`` most frequent words are sent to every task (8 MB whatever the corpus), all other words are joined.

The model reads and predicts each word's subword ids. An input is the sum of an embedding of its own id, one of its
class (by a leading space and the size of its rank) and one of its place. From up to 15 ids before it, attention gives
the probability of the next class, and then that of the id within its class by yes-no decisions down a tree (Huffman's,
of the id counts): each decision starts from the counts and is moved by what attention knows, so the probabilities of
all ids sum to 1. Windows of ``WINDOW`` ids overlap by ``CONTEXT``: each id is scored once, with at least so much context
where the text has it; causal and border masks are batched.

Training reads every id of every training text once, in the windows that scoring uses. Stretches of windows are dealt by
a hash of document and place into parts of about ``PART`` windows, and the parts into at most ``ROUNDS`` rounds. Each
part steps from the weights of the round before, in the order of its hashes; what the parts changed is averaged, rows of
the id tables by how often a part used them. Steps and result depend on the corpus, not on how its files are cut.

Cases: null text is empty, and an empty text is its end alone; a null id is neither trained on nor held out; without
training texts all counts are 0 and the model is its start; repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, SparkFiles
from pyspark.sql import Column, DataFrame, functions as F

from ..plans.stage import stage
from .grams import BASES, Texts, Words, mix, ragged, signed, slices

HEAD = 1 << 19
WORDS_HELD = 600_000
"""Different words a task counts before it passes them on."""
KEPT_WORDS = 500_000
"""Words whose ids a worker keeps; when there are more, it starts over."""
WINDOW, STRIDE, WIDTH = 16, 12, 8
CONTEXT = WINDOW - STRIDE
STRETCH = 64
"""Windows that are dealt out together."""
PART, ROUNDS, PARTS_A_TASK = 1 << 15, 8, 8
BATCH, RATE, TABLE_RATE = 256, 0.02, 0.1
SLICE = 1 << 16
"""Numbers of a model that are added up in one group."""
SIZES = 8
CLASSES = 2 * SIZES + 1  # the last is the end
START = CLASSES
BLOCK = 2048
"""Windows that are scored at once."""
PLACES = 4096
"""Places whose decisions are scored at once."""
END_HASH = np.uint64(0x5851F42D4C957F2D)


class Subwords:
    """Ids of words by a rank file, and the class of each id; the end has the id after the last rank."""

    def __init__(self, path: str, pattern: str):
        import base64

        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding("subwords", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.end = max(ranks.values()) + 1
        self.kinds = np.zeros(self.end + 1, np.int16)
        self.spaced = np.zeros(self.end + 1, bool)
        for token, rank in ranks.items():
            self.spaced[rank] = token.startswith(b" ")
            self.kinds[rank] = SIZES * token.startswith(b" ") + min(SIZES - 1, (rank + 1).bit_length() // 2)
        self.kinds[self.end] = CLASSES - 1
        self.packed = np.dtype("<u2" if self.end < 1 << 16 else "<u4")
        self.input_kinds = self.kinds.copy()
        self.input_kinds[self.end] = START  # as an input, an end is what stands before a text
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # hashes of the words kept, in order; their ids in ``pool`` and how many
        self.begins, self.lengths, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, self.packed)

    def of_words(self, words: Words, first: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many for each word) of the words that ``first`` points at; ``hashes``: theirs, rising."""
        if len(self.keys) > KEPT_WORDS:
            self._forget()
        at = np.searchsorted(self.keys, hashes)
        new = np.ones(len(hashes), bool)
        inside = at < len(self.keys)
        new[inside] = self.keys.take(at[inside]) != hashes[inside]
        if new.any():
            ids, lengths = self._encoded(words, first[new])
            before = at[new]
            self.keys = np.insert(self.keys, before, hashes[new])
            self.begins = np.insert(self.begins, before, len(self.pool) + np.cumsum(lengths) - lengths)
            self.lengths = np.insert(self.lengths, before, lengths)
            self.pool = np.concatenate([self.pool, ids.astype(self.packed)])
            at += np.cumsum(new) - new
        lengths = self.lengths.take(at)
        return self.pool.take(ragged(self.begins.take(at), lengths)).astype(np.int64), lengths

    def _encoded(self, words: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many for each word) of words encoded together, each after a space: a word holds no space, so it begins
        where an id does whose token begins with one. If an odd space inside a word hides that, halves are encoded."""
        sizes = words.ends[which] - words.starts[which] + 1
        joined = words.texts.data.take(ragged(words.starts[which] - 1, sizes), mode="clip")
        joined[np.cumsum(sizes) - sizes] = 32
        ids = np.array(self.encode(joined.tobytes().decode()), np.int64)
        begins = np.flatnonzero(self.spaced[ids])
        if len(which) == 1:
            return ids, np.array([len(ids)])
        if len(begins) == len(which):
            return ids, np.diff(begins, append=len(ids))
        halves = [self._encoded(words, half) for half in np.array_split(which, 2)]
        return np.concatenate([x for x, _ in halves]), np.concatenate([n for _, n in halves])


_loaded: dict[tuple[str, str], Subwords] = {}


def _subwords(name: str, pattern: str) -> Subwords:
    if (name, pattern) not in _loaded:
        _loaded[name, pattern] = Subwords(SparkFiles.get(name), pattern)
    return _loaded[name, pattern]


class Tokens:
    """Words, their different hashes, and the subword ids of a slice of texts, with one end for each text."""

    def __init__(self, column: pa.Array, subwords: Subwords):
        self.words = words = Texts(column).lower().words()
        order = np.argsort(words.hashes())
        in_order = words.hashes().take(order)
        opens = np.ones(len(order), bool)
        opens[1:] = in_order[1:] != in_order[:-1]
        self.hashes, first = in_order[opens], order[opens]
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(opens) - 1
        ids, lengths = subwords.of_words(words, first, self.hashes)
        self.unique_ids, self.unique_lengths = ids, lengths
        self.subwords = subwords

    def ids(self) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): of each text, its end included."""
        lengths = self.unique_lengths
        per_word = lengths[self.which]
        sums = np.concatenate([[0], np.cumsum(per_word)])[self.words.offsets]
        offsets = sums + np.arange(len(sums))
        ids = np.full(offsets[-1], self.subwords.end)
        inside = np.ones(offsets[-1], bool)
        inside[offsets[1:] - 1] = False
        ids[inside] = self.unique_ids[ragged((np.cumsum(lengths) - lengths)[self.which], per_word)]
        return ids, offsets

    def stretches(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, lengths, text, number in it) of the stretches of up to STRETCH windows: each holds the ids it trains on,
        after the CONTEXT + 1 before them (ends where the text has none). They cover every id of every text once."""
        ids, offsets = self.ids()
        sizes, most = np.diff(offsets), STRETCH * STRIDE
        n = -(-sizes // most)
        text = np.repeat(np.arange(len(n)), n)
        number = ragged(np.zeros(len(n), np.int64), n)
        start = offsets[text] + number * most
        lengths = np.minimum(most, offsets[text + 1] - start) + CONTEXT + 1
        at = ragged(start - CONTEXT - 1, lengths)
        inside = at >= np.repeat(offsets[text], lengths)
        return np.where(inside, ids[np.maximum(at, 0)], self.subwords.end), lengths, text, number

    def training_windows(self) -> tuple[np.ndarray, ...]:
        """``laid_out`` of all windows of each text."""
        return laid_out(*self.stretches()[:2], self.subwords)


def laid_out(ids: np.ndarray, lengths: np.ndarray, subwords: Subwords) -> tuple[np.ndarray, ...]:
    """(class inputs, class targets, id inputs, id targets) of the windows of stretches; class targets are -1 where none is."""
    n = -(-(lengths - CONTEXT - 1) // STRIDE)
    begin = np.cumsum(lengths) - lengths
    which = np.repeat(np.arange(len(n)), n)
    at = (begin[which] + ragged(np.zeros(len(n), np.int64), n) * STRIDE)[:, None] + np.arange(WINDOW + 1)
    there = at < (begin + lengths)[which, None]
    own = np.where(there, ids.take(at, mode="clip") if len(ids) else 0, subwords.end)
    targets = np.where(there[:, 1:] & (np.arange(WINDOW) >= CONTEXT), subwords.kinds.take(own[:, 1:]), -1)
    return subwords.input_kinds.take(own[:, :-1]), targets, own[:, :-1], own[:, 1:]


def score_windows(ids: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, targets, first place of each window, its text). Every text is laid out after CONTEXT empty places and
    filled up to whole strides; window i begins at its place i * STRIDE and scores all but its first CONTEXT places."""
    sizes = np.diff(offsets)
    n = -(-sizes // STRIDE)
    region = n * STRIDE + CONTEXT
    start = np.cumsum(region) - region
    targets = np.full(int(region.sum()), -1, np.int32)
    place = ragged(start + CONTEXT, sizes)
    targets[place] = ids
    inputs = np.full(len(targets), end, np.int32)
    inputs[1:] = np.where(targets[:-1] < 0, end, targets[:-1])
    inputs[start + CONTEXT] = end
    text = np.repeat(np.arange(len(sizes)), n)
    return inputs, targets, start[text] + ragged(np.zeros(len(n), np.int64), n) * STRIDE, text


class Tree:
    """Huffman's tree of the ids of each class, by their counts. ``nodes`` and ``signs`` from ``offsets[id]`` are the
    decisions on the way to an id (1 for a node's side 1, else -1), ``prior`` the log odds of side 1 by the counts."""

    def __init__(self, kinds: np.ndarray, counts: np.ndarray):
        n, weight = len(kinds), (counts + 0.5).tolist()
        parent, side = np.full(2 * n, -1), np.zeros(2 * n, np.int8)
        prior = np.zeros(n, np.float32)
        order = np.lexsort((np.arange(n), counts, kinds))
        new = 0
        for leaves in np.split(order, np.flatnonzero(np.diff(kinds[order])) + 1):
            leaves, made, i, j = leaves.tolist(), [], 0, 0  # two queues, both by weight
            for _ in range(len(leaves) - 1):
                pair = []
                for _ in range(2):
                    if j >= len(made) or i < len(leaves) and weight[leaves[i]] <= weight[made[j]]:
                        pair.append(leaves[i])
                        i += 1
                    else:
                        pair.append(made[j])
                        j += 1
                low, high = pair
                parent[low] = parent[high] = n + new
                side[high] = 1
                prior[new] = np.log(weight[high] / weight[low])
                weight.append(weight[low] + weight[high])
                made.append(n + new)
                new += 1
        steps, at = [], np.arange(n)
        while (parent[at] >= 0).any():
            steps.append((np.where(parent[at] >= 0, parent[at] - n, -1), side[at]))
            at = np.where(parent[at] >= 0, parent[at], at)
        nodes = np.array([x for x, _ in steps]).reshape(len(steps), n).T
        sides = np.array([x for _, x in steps]).reshape(len(steps), n).T
        self.lengths = (nodes >= 0).sum(axis=1)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.nodes, self.prior = nodes[nodes >= 0], prior
        self.signs = (2 * sides[nodes >= 0] - 1).astype(np.float32)

    def ways(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which of ``ids``, node, sign) of all decisions on the way to each."""
        lengths = self.lengths.take(ids)
        ends = np.cumsum(lengths)
        which = np.repeat(np.arange(len(ids)), lengths)
        at = (self.offsets.take(ids) - ends + lengths).take(which)
        at += np.arange(len(at))
        return which, self.nodes.take(at), self.signs.take(at)


SHAPES = {
    "embedding": (CLASSES + 1, WIDTH), "place": (WINDOW, WIDTH), "query": (WIDTH, WIDTH), "key": (WIDTH, WIDTH),
    "value": (WIDTH, WIDTH), "out": (WIDTH, CLASSES), "bias": (CLASSES,),
}
CAUSAL = np.tril(np.ones((WINDOW, WINDOW), np.float32))


TABLES = ("piece", "node")
"""Embeddings of the ids, and of the decisions of the tree; they start at 0."""


def start_weights(seed: int = 5, kinds: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """``kinds``: of each id, for the tables; without, the model knows classes alone. Classes without ids are as good as
    impossible."""
    rng = np.random.default_rng(seed)
    scale = {"bias": 0.0, "place": 0.05}
    out = {k: (rng.normal(size=s) * scale.get(k, 0.3)).astype(np.float32) for k, s in SHAPES.items()}
    if kinds is None:
        return out
    out["bias"][np.bincount(kinds, minlength=CLASSES) == 0] = -30
    return out | {k: np.zeros((len(kinds), WIDTH), np.float32) for k in TABLES}


LIMIT = 60


def _exp(x: np.ndarray, more: int = 0) -> np.ndarray:
    """exp(x) + more, in place and without the largest-first step of a softmax: products and logits of so small a model
    stay far below what float32 can take as an exponent, and are cut at ``LIMIT`` to be sure."""
    np.clip(x, -LIMIT, LIMIT, out=x)
    np.exp(x, out=x)
    if more:
        x += more
    return x


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def attend(w: dict[str, np.ndarray], inputs: np.ndarray, ids: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """What each place of each window knows: its own input (class and id) and, by attention, those before it."""
    x = w["embedding"][inputs] + w["place"]
    if ids is not None:
        x = x + w["piece"][ids]
    q, k, v = x @ w["query"], x @ w["key"], x @ w["value"]
    a = _softmax(np.where(CAUSAL > 0, q @ k.transpose(0, 2, 1) * np.float32(WIDTH**-0.5), np.float32(-1e9)))
    return x, q, k, v, a, x + a @ v


def _spread(values: np.ndarray, width: int) -> np.ndarray:
    """Each value in a row of ``width``: with short rows faster than numpy's own broadcast of a column."""
    return values.repeat(width).reshape(-1, width)


def _add_rows(out: np.ndarray, rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """``out`` with each of ``values`` added to its row; two columns at a time, as complex numbers are added."""
    pair = np.result_type(values.dtype, np.complex64)
    for column, part in zip(out.view(pair).T, values.view(pair).T):
        np.add.at(column, rows, part)
    return out


def _by_row(rows: np.ndarray, values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different rows of ``size``, the sum of the values of each, and how many there are."""
    place, order = np.empty(size, np.intp), np.arange(len(rows))  # read only where written
    place[rows] = order
    different = rows.take(np.flatnonzero(place.take(rows) == order))
    place[different] = order[: len(different)]
    place = place.take(rows)
    sums = _add_rows(np.zeros((len(different), values.shape[1]), values.dtype), place, values)
    return different, sums, np.bincount(place, minlength=len(different))


def gradients(
    w: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray, input_ids: np.ndarray | None = None,
    target_ids: np.ndarray | None = None, tree: Tree | None = None, with_loss: bool = True,
) -> tuple[float, dict]:
    """Mean cross-entropy of the targets that are there (0 without ``with_loss``), and its gradients; those of the tables
    by row (``_by_row``). Places before the first that has a target in any window ask nothing. Sums over short rows are
    products with ones, and all windows are one matrix wherever they share a factor."""
    first = 0 if (targets[:, :CONTEXT] >= 0).any() else CONTEXT
    x = w["embedding"].take(inputs, axis=0) + w["place"]
    if tree is not None:
        x += w["piece"].take(input_ids, axis=0)
    windows, dtype, scale = len(x), x.dtype, x.dtype.type(WIDTH**-0.5)
    ones = np.ones(WINDOW, dtype)
    rows = x.reshape(-1, WIDTH)
    asking = x[:, first:].reshape(-1, WIDTH)
    shape = (windows, WINDOW - first, -1)
    q = (asking @ (w["query"] * scale)).reshape(shape)
    k, v = (rows @ w["key"]).reshape(x.shape), (rows @ w["value"]).reshape(x.shape)
    a = q @ np.ascontiguousarray(k.transpose(0, 2, 1))
    _exp(a)
    a *= CAUSAL[first:]
    flat = a.reshape(-1, WINDOW)
    flat *= _spread(1 / (flat @ ones), WINDOW)
    h = (a @ v).reshape(-1, WIDTH)
    h += asking

    p = np.ascontiguousarray(w["out"].T) @ h.T  # a row for each class
    p += w["bias"][:, None]
    _exp(p)
    p *= 1 / p.sum(axis=0)
    targets = targets[:, first:].ravel()
    there = targets >= 0
    n = max(1, np.count_nonzero(there))
    right = np.maximum(targets, 0), np.arange(len(targets))
    loss = -np.log(np.maximum(p[right][there], 1e-9)).sum() / n if with_loss else 0.0
    p[right] -= 1
    p *= there * dtype.type(1 / n)
    g = {"out": h.T @ p.T, "bias": p.sum(axis=1)}
    dh = p.T @ w["out"].T
    if tree is not None:
        asked = np.flatnonzero(there)
        which, nodes, signs = tree.ways(target_ids[:, first:].ravel().take(asked))
        which = asked.take(which)
        known, decides = h.take(which, axis=0), w["node"].take(nodes, axis=0)
        z = tree.prior.take(nodes) + (known * decides) @ ones[:WIDTH]
        z *= signs
        if with_loss:
            loss += np.logaddexp(0, -z).sum() / n
        dz = signs / _exp(z, 1) * dtype.type(-1 / n)
        dz = _spread(dz, WIDTH)
        known *= dz
        decides *= dz
        g["node"] = _by_row(nodes, known, len(w["node"]))
        _add_rows(dh, which, decides)

    dv = a.transpose(0, 2, 1) @ dh.reshape(shape)
    da = dh.reshape(shape) @ v.transpose(0, 2, 1)
    da *= a
    flat *= _spread(da.reshape(-1, WINDOW) @ ones, WINDOW)
    da -= a
    dq, dk = (da @ k).reshape(-1, WIDTH), (da.transpose(0, 2, 1) @ q).reshape(-1, WIDTH)
    dq *= scale
    dv = dv.reshape(-1, WIDTH)
    g["query"], g["key"], g["value"] = asking.T @ dq, rows.T @ dk, rows.T @ dv
    dh += dq @ w["query"].T
    dx = dk @ w["key"].T
    dx += dv @ w["value"].T
    dx.reshape(x.shape)[:, first:] += dh.reshape(shape)
    g["place"] = dx.reshape(x.shape).sum(axis=0)
    kinds = inputs.ravel()
    if tree is not None:
        g["piece"] = _by_row(input_ids.ravel(), dx, len(w["piece"]))
        kind = np.empty(len(w["piece"]), np.intp)  # read only where written
        kind[input_ids.ravel()] = kinds
        kinds, dx = kind.take(g["piece"][0]), g["piece"][1]
    g["embedding"] = _add_rows(np.zeros((CLASSES + 1, WIDTH), dtype), kinds, dx)
    return float(loss), g


class Trainer:
    """Adam (Adagrad for the tables) over batches of windows, in the order they come. ``done``: steps taken before."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None, tree: Tree | None = None, done: int = 0):
        self.weights = {k: v.copy() for k, v in (weights or start_weights()).items()}
        # what Adam steps is one vector, of which ``weights`` has views
        self.small = np.concatenate([self.weights[k].ravel() for k in SHAPES])
        edges = np.cumsum([self.weights[k].size for k in SHAPES])[:-1]
        self.weights |= {k: part.reshape(SHAPES[k]) for k, part in zip(SHAPES, np.split(self.small, edges))}
        self.tree, self.done = tree, done
        self.first, self.second_small = np.zeros_like(self.small), np.zeros_like(self.small)
        self.second = {k: np.zeros_like(self.weights[k]) for k in TABLES if k in self.weights}
        self.used = {k: np.zeros(len(self.weights[k]), np.float32) for k in TABLES if k in self.weights}
        self.steps = self.seen = 0
        self.waiting: list[tuple[np.ndarray, ...]] = []
        self.n_waiting = 0

    def add(self, *windows: np.ndarray) -> None:
        self.waiting.append(windows)
        self.n_waiting += len(windows[0])
        if self.n_waiting >= BATCH:
            self._take(self.n_waiting // BATCH * BATCH)

    def flush(self) -> None:
        self._take(self.n_waiting)

    def _take(self, n: int) -> None:
        if not n:
            return
        windows = [np.concatenate(x) for x in zip(*self.waiting)]
        self.waiting, self.n_waiting = [tuple(x[n:] for x in windows)], self.n_waiting - n
        for at in range(0, n, BATCH):
            batch = [x[at : min(n, at + BATCH)] for x in windows]
            _, g = gradients(self.weights, *batch, tree=self.tree, with_loss=False)
            self.steps += 1
            rate = 1 / (1 + (self.done + self.steps) / 400)
            grad = np.concatenate([g[k].ravel() for k in SHAPES])
            self.first = 0.9 * self.first + 0.1 * grad
            self.second_small = 0.99 * self.second_small + 0.01 * grad**2
            step = self.first / (1 - 0.9**self.steps) / (np.sqrt(self.second_small / (1 - 0.99**self.steps)) + 1e-8)
            self.small -= RATE * rate * step
            for k in TABLES:
                if k in g:
                    rows, grad, times = g[k]
                    squares = self.second[k].take(rows, axis=0) + grad * grad
                    self.second[k][rows] = squares
                    self.weights[k][rows] -= TABLE_RATE * rate * grad / (np.sqrt(squares) + 1e-8)
                    self.used[k][rows] += times
        self.seen += n


class Scorer:
    """``attend`` by tables over ids and places."""

    def __init__(self, w: dict[str, np.ndarray], tree: Tree | None = None):
        self.w, self.tree = w, tree
        self.out, self.bias = np.ascontiguousarray(w["out"].T), w["bias"][:, None]
        self.x: np.ndarray | None = None

    def prepare(self, subwords: Subwords) -> None:
        if self.x is not None:
            return
        w, scale = self.w, np.float32(WIDTH**-0.5)
        x, place = w["embedding"][subwords.input_kinds], w["place"]
        self.x = x + w["piece"] if "piece" in w else x
        self.place = place[CONTEXT:]
        self.query, self.query_place = self.x @ w["query"] * scale, place[CONTEXT:] @ w["query"] * scale
        self.key, self.key_place = self.x @ w["key"], place @ w["key"]
        self.value, self.value_place = self.x @ w["value"], place @ w["value"]

    def log10(self, inputs: np.ndarray, targets: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """log10 P of the scored places of each window, 0 where no target is; ``targets`` of those alone."""
        windows, asking = len(inputs), inputs[:, CONTEXT:]

        def rows(table: np.ndarray, ids: np.ndarray, place: np.ndarray) -> np.ndarray:
            found = table.take(ids, axis=0)
            found.reshape(windows, -1)[:] += place.ravel()
            return found

        key = rows(self.key, inputs, self.key_place)
        a = rows(self.query, asking, self.query_place) @ np.ascontiguousarray(key.transpose(0, 2, 1))
        _exp(a)
        a *= CAUSAL[CONTEXT:]
        h = (a @ rows(self.value, inputs, self.value_place)).reshape(-1, WIDTH)
        h *= _spread(1 / (a.reshape(-1, WINDOW) @ np.ones(WINDOW, np.float32)), WIDTH)
        h += rows(self.x, asking, self.place).reshape(-1, WIDTH)
        logits = self.out @ h.T
        logits += self.bias
        targets = targets.ravel()
        there = targets >= 0
        asked = np.where(there, targets, len(kinds) - 1)  # the end is alone in its class: no decisions
        right = np.clip(logits[kinds.take(asked), np.arange(len(asked))], -LIMIT, LIMIT)
        scores = (right - np.log(_exp(logits).sum(axis=0))).astype(np.float64)
        if self.tree is not None:
            ones = np.ones(WIDTH, np.float32)
            for at in range(0, len(asked), PLACES):
                which, nodes, signs = self.tree.ways(asked[at : at + PLACES])
                known = h[at : at + PLACES].take(which, axis=0)
                known *= self.w["node"].take(nodes, axis=0)
                z = self.tree.prior.take(nodes) + known @ ones
                z *= -signs
                scores[at : at + PLACES] -= np.bincount(which, np.log1p(_exp(z)), len(asked[at : at + PLACES]))
        scores *= there
        return (scores / np.log(10)).reshape(-1, STRIDE)


def model_log10(scorer: Scorer, tokens: Tokens, inside_log10: np.ndarray | None = None) -> np.ndarray:
    """log10 probability of each text. ``inside_log10``: of each id within its class, for a scorer without a tree."""
    ids, offsets = tokens.ids()
    scorer.prepare(tokens.subwords)
    inputs, targets, first, text = score_windows(ids, offsets, tokens.subwords.end)
    n = len(offsets) - 1
    sums = np.zeros(n)
    places, asked = np.arange(WINDOW), np.arange(CONTEXT, WINDOW)
    for at in range(0, len(first), BLOCK):
        block = first[at : at + BLOCK, None]
        values = scorer.log10(inputs[block + places], targets[block + asked], tokens.subwords.kinds)
        sums += np.bincount(text[at : at + BLOCK], values.sum(axis=1), n)
    if scorer.tree is None:
        sums += np.bincount(np.repeat(np.arange(n), np.diff(offsets)), inside_log10[ids], n)
    return sums


# Kinds of what the first pass gives: counts of words, of ids, and stretches (key is their hash, n their windows).
WORD, ID, STRETCHES = 0, 1, 2
GATHERED = "kind int, key bigint, n bigint, ids binary"


def gather(documents: DataFrame, training: Column, name: str, pattern: str) -> DataFrame:
    """One pass over the training texts: each task's word counts and id counts, and all stretches."""

    def rows(kind: int, keys: np.ndarray, n: np.ndarray, ids: pa.Array | None = None) -> pa.RecordBatch:
        ids = pa.nulls(len(keys), pa.binary()) if ids is None else ids
        columns = [pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys), pa.array(n), ids]
        return pa.RecordBatch.from_arrays(columns, ["kind", "key", "n", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subwords = _subwords(name, pattern)
        texts = 0
        ids = np.zeros(subwords.end + 1, np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return keys, np.bincount(back, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)

        for whole in batches:
            for batch in slices(whole):
                tokens = Tokens(batch["text"], subwords)
                counts = np.bincount(tokens.which, minlength=len(tokens.hashes))
                parts.append((tokens.hashes, counts))
                held += len(counts)
                of_word = np.repeat(counts, tokens.unique_lengths)
                ids += np.bincount(tokens.unique_ids, of_word, len(ids)).astype(np.int64)
                texts += batch.num_rows
                own, lengths, text, number = tokens.stretches()
                row = np.asarray(batch["row"]).view(np.uint64)[text]
                key = mix(mix(row) + number.astype(np.uint64) * np.uint64(BASES[0]))
                edges = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32) * subwords.packed.itemsize
                packed = pa.Array.from_buffers(pa.binary(), len(key), [None, pa.py_buffer(edges), pa.py_buffer(own.astype(subwords.packed))])
                yield rows(STRETCHES, signed(key), -(-(lengths - CONTEXT - 1) // STRIDE), packed)
                if held > 2 * WORDS_HELD:
                    parts = [merged()]
                    held = len(parts[0][0])
                    if held > WORDS_HELD:
                        yield rows(WORD, signed(parts[0][0]), parts[0][1])
                        parts, held = [], 0
        if parts:
            keys, n = merged()
            yield rows(WORD, signed(keys), n)
        yield rows(WORD, signed(np.array([END_HASH])), np.array([texts]))
        ids[subwords.end] = texts
        used = np.flatnonzero(ids)
        yield rows(ID, used, ids[used])

    known = documents.where(training).select(F.xxhash64("doc_id").alias("row"), "text")
    return known.mapInArrow(run, GATHERED)


def train(stretches: DataFrame, id_counts: np.ndarray, name: str, pattern: str) -> tuple[dict[str, np.ndarray], Broadcast]:
    """The model after all rounds over ``stretches``, and the tree of its ids, which all tasks have."""
    spark = stretches.sparkSession
    size, kinds = len(id_counts), _subwords(name, pattern).kinds
    tree, weights = Tree(kinds, id_counts), start_weights(kinds=kinds)
    windows = stretches.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = -(-windows // PART)
    rounds = min(ROUNDS, parts)
    part = F.pmod("key", F.lit(max(parts, 1)))

    held_tree = spark.sparkContext.broadcast(tree)

    def one_round(turn: int, shared: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            before, decisions = shared.value, held_tree.value
            subwords = _subwords(name, pattern)
            total = np.zeros(sum(v.size for v in before.values()) + len(TABLES) * size + 1)
            trainer, current = None, None

            def add() -> None:
                trainer.flush()
                at = 0
                for k, v in before.items():
                    times = trainer.used[k][:, None] if k in TABLES else trainer.seen
                    total[at : at + v.size] += ((trainer.weights[k] - v) * times).ravel()
                    at += v.size
                for k in TABLES:
                    total[at : at + size] += trainer.used[k]
                    at += size
                total[at] += trainer.seen

            for whole in batches:
                numbers = np.asarray(whole["part"])
                edges = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
                for a, b in zip(edges[:-1], edges[1:]):
                    if a == b:
                        continue
                    if numbers[a] != current:
                        if trainer:
                            add()
                        trainer, current = Trainer(before, decisions, turn * (PART // BATCH)), numbers[a]
                    for at in range(a, b, 16):
                        packed = [np.frombuffer(x.as_buffer(), subwords.packed) for x in whole["ids"][at : min(b, at + 16)]]
                        lengths = np.array([len(x) for x in packed])
                        trainer.add(*laid_out(np.concatenate(packed).astype(np.int64), lengths, subwords))
            if trainer:
                add()
                cut = [total[at : at + SLICE].astype("<f4").tobytes() for at in range(0, len(total), SLICE)]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cut), dtype=np.int32)), pa.array(cut, pa.binary())], ["slice", "total"])

        def added(table: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(x.as_buffer(), "<f4").astype(float) for x in table["total"]).astype("<f4")
            return pa.table({"slice": table["slice"][:1], "total": pa.array([total.tobytes()], pa.binary())})

        mine = stretches.where(part % rounds == turn).select(part.alias("part"), "key", "ids")
        tasks = max(1, -(-parts // (rounds * PARTS_A_TASK)))
        dealt = mine.repartition(tasks, "part").sortWithinPartitions("part", "key", "ids")
        out = "slice int, total binary"
        return dealt.mapInArrow(run, out).groupBy("slice").applyInArrow(added, out)

    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(weights)
        found = sorted(one_round(turn, shared).collect())
        shared.destroy()
        if not found:
            continue
        total = np.concatenate([np.frombuffer(r["total"], "<f4") for r in found])
        ends = np.cumsum([v.size for v in weights.values()])
        used = {k: total[ends[-1] + i * size :][:size, None] for i, k in enumerate(TABLES)}
        weights = {
            k: (v + total[e - v.size : e].reshape(v.shape) / np.maximum(used.get(k, total[-1]), 1)).astype(np.float32)
            for (k, v), e in zip(weights.items(), ends)
        }
    return weights, held_tree


def _least_count(counts: DataFrame, head: int) -> int:
    """The smallest power of 2 ** (1 / 8), rounded up, that at most ``head`` words reach."""
    level = F.floor(F.log2("c") * 8).cast("int").alias("level")
    sizes = {r["level"]: r["n"] for r in counts.groupBy(level).agg(F.count(F.lit(1)).alias("n")).collect()}  # 8 for each bit
    total, least = 0, max(sizes, default=0) + 1
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > head:
            break
        least = at
    return int(np.ceil(2 ** (least / 8) - 1e-9))


SCORED = "row bigint, doc_id bigint, n_tokens bigint, n_head bigint, head_log10 double, score double, tail array<struct<word:bigint,times:int>>"


def score(documents: DataFrame, training: Column, path: str, pattern: str, head: int = HEAD) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score for each row of ``documents``."""
    spark = documents.sparkSession
    spark.sparkContext.addFile(path)
    name = path.rsplit("/", 1)[-1]
    passed = stage(gather(documents, training, name, pattern).where("n > 0"), "passed")
    gathered = stage(passed.where(F.col("kind") != STRETCHES).groupBy("kind", "key").agg(F.sum("n").alias("n")), "gathered")
    counts = gathered.where(F.col("kind") == WORD).select(F.col("key").alias("word"), F.col("n").alias("c"))
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_train, smoothed = int(totals["n"]), totals["n"] + 0.5 * (totals["v"] + 1)
    frequent = counts.where(F.col("c") >= _least_count(counts, head)).toPandas().sort_values("word")
    found = gathered.where(F.col("kind") == ID).select("key", "n").toPandas()
    id_counts = np.zeros(_subwords(name, pattern).end + 1, np.int64)
    id_counts[found["key"].to_numpy()] = found["n"].to_numpy()
    ends = int(id_counts[-1])  # one for each training text
    model, tree = train(passed.where(F.col("kind") == STRETCHES), id_counts, name, pattern)
    shared = spark.sparkContext.broadcast((frequent["word"].to_numpy(), frequent["c"].to_numpy(), model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subwords = _subwords(name, pattern)
        words, c, model = shared.value
        log_c, scorer = np.log10(c + 0.5), Scorer(model, tree.value)
        for whole in batches:
            for batch in slices(whole):
                tokens = Tokens(batch["text"], subwords)
                rows, counts = batch.num_rows, tokens.words.counts
                mine = signed(tokens.hashes)
                at = np.minimum(np.searchsorted(words, mine), max(len(words) - 1, 0))
                known = words[at] == mine if len(words) else np.zeros(len(mine), bool)
                value = np.where(known, log_c[at] if len(words) else 0.0, 0.0)
                docs = np.repeat(np.arange(rows), counts)
                in_head = known[tokens.which]
                head_sum = np.bincount(docs, value[tokens.which], rows) + np.log10(ends + 0.5)
                n_head = np.bincount(docs[in_head], minlength=rows) + int(ends > 0)
                pairs, times = np.unique(docs[~in_head] * len(mine) + tokens.which[~in_head], return_counts=True)
                tail = pa.StructArray.from_arrays(
                    [pa.array(mine[pairs % len(mine)] if len(mine) else np.zeros(0, np.int64)), pa.array(times.astype(np.int32))],
                    ["word", "times"],
                )
                edges = np.searchsorted(pairs // max(len(mine), 1), np.arange(rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["row"], batch["doc_id"], pa.array(counts.astype(np.int64) + 1), pa.array(n_head.astype(np.int64)),
                        pa.array(head_sum), pa.array(model_log10(scorer, tokens)),
                        pa.ListArray.from_arrays(pa.array(edges), tail),
                    ],
                    ["row", "doc_id", "n_tokens", "n_head", "head_log10", "score", "tail"],
                )

    numbered = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    scored = stage(numbered.mapInArrow(run, SCORED), "scored")
    tail = scored.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.times")
    rare = tail.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rare_log10"),
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("n_rare"),
    )
    total = F.col("head_log10") + F.coalesce("rare_log10", F.lit(0.0))
    return scored.drop("tail").join(rare, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_head") + F.coalesce("n_rare", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(n_train).cast("bigint").alias("train_tokens"),
        (total - F.col("n_tokens") * F.log10(F.lit(float(smoothed)))).alias("base_score"), "score",
    )
