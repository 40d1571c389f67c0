"""A small causal self-attention language model on subword ids, in numpy.

One attention layer with learnt distances and one feed-forward layer. Texts lie in blocks of
STRIDE tokens; a window is a block and the one before it, and scores the tokens of its
own block. So windows overlap by half, every token is scored once, and each sees STRIDE tokens
at least where the text has them. A token is predicted as a class and a member of that class;
rare tokens share one class and take their share of it by their counts.

The logits start from what the corpus counts say of the token after the last one; the layers
learn what the longer context adds.
"""

from dataclasses import dataclass, field

import numpy as np

STRIDE = 16
WIDTH = 16  # of the vectors
CLASSES, MEMBERS = 32, 32  # frequent tokens: CLASSES x MEMBERS
RARE_INPUTS = 64  # rare tokens share this many input vectors
BLOCKS = 1024  # whose tokens are scored at once
# So few stay in the cache, and their products below a million multiplications, which BLAS does without packing.
ATTEND = 48  # blocks that attend at once
ROWS = 768  # tokens whose logits are worked on at once


PULL = 5.0  # tokens that the overall counts weigh against those after one token


@dataclass
class Vocabulary:
    """counts: of each subword id in the training text, the end mark last."""

    counts: np.ndarray
    inputs: np.ndarray = field(init=False)
    group: np.ndarray = field(init=False)  # CLASSES for rare tokens
    member: np.ndarray = field(init=False)
    rare: np.ndarray = field(init=False)  # log probability among rare tokens
    after: np.ndarray = field(init=False)  # log probabilities of class and member, by class and the input before

    def __post_init__(self):
        n, head = len(self.counts), CLASSES * MEMBERS
        order = np.lexsort((np.arange(n), -self.counts))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        frequent = place < head
        self.inputs = np.where(frequent, place, head + np.arange(n) % RARE_INPUTS).astype(np.int32)
        self.group = np.where(frequent, place // MEMBERS, CLASSES).astype(np.int32)
        self.member = np.where(frequent, place % MEMBERS, 0).astype(np.int32)
        weight = np.where(frequent, 0, self.counts + 0.5)
        self.rare = np.where(frequent, 0, np.log(np.maximum(weight, 1e-9) / max(weight.sum(), 1e-9))).astype(np.float32)

    @property
    def begin(self) -> int:
        return CLASSES * MEMBERS + RARE_INPUTS

    @property
    def blank(self) -> int:
        return self.begin + 1

    @property
    def outcomes(self) -> np.ndarray:
        """Column of each subword id in a table of pairs; rare ones share the last."""
        return np.minimum(self.inputs, CLASSES * MEMBERS)

    def learn_pairs(self, pairs: np.ndarray) -> None:
        """pairs: (inputs, outcomes) counts of a token after another."""
        head = CLASSES * MEMBERS
        overall = np.bincount(self.outcomes, self.counts + 0.5, head + 1)
        table = pairs + PULL * overall / overall.sum()
        table = np.vstack((table, overall[None, :]))  # a blank is never read before a token
        members = table[:, :head].reshape(-1, CLASSES, MEMBERS)
        groups = np.concatenate((members.sum(2), table[:, head:]), 1)
        # Rare tokens have no member: theirs count as nothing.
        self.after = np.zeros((CLASSES + 1, len(table), CLASSES + 1 + MEMBERS), np.float32)
        self.after[:, :, : CLASSES + 1] = np.log(groups / groups.sum(1, keepdims=True))
        self.after[:CLASSES, :, CLASSES + 1 :] = np.log(members / members.sum(2, keepdims=True)).transpose(1, 0, 2)


# A bias is the last row of its weights; vectors of texts carry a one behind them for it.
SHAPES = {
    "vectors": (CLASSES * MEMBERS + RARE_INPUTS + 2, WIDTH),
    "query": (WIDTH, WIDTH), "key": (WIDTH, WIDTH), "value": (WIDTH, WIDTH),
    "distance": (2 * STRIDE,),
    "first": (WIDTH + 1, 2 * WIDTH), "second": (2 * WIDTH, WIDTH),
    "group": (WIDTH + 1, CLASSES + 1),
    "member": (CLASSES, WIDTH + 1, MEMBERS),
}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())


def views(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[name] = flat[at : at + n].reshape(shape)
        at += n
    return out


def initial(vocabulary: Vocabulary, seed: int = 3) -> np.ndarray:
    """Small random weights. The layers that end in logits start at zero, where the counts hold."""
    rng = np.random.default_rng(seed)
    flat = np.zeros(SIZE, np.float32)
    w = views(flat)
    for name in ("vectors", "query", "key", "value", "first", "second"):
        drawn = w[name][:WIDTH] if name == "first" else w[name]
        drawn[:] = rng.normal(0, 0.3 if name == "vectors" else drawn.shape[-2] ** -0.5 * 0.7, drawn.shape)
    w["vectors"][vocabulary.blank] = 0
    w["distance"][:] = -0.2 * np.arange(2 * STRIDE)
    return flat


_AGO = np.arange(STRIDE)[:, None] + STRIDE - np.arange(2 * STRIDE)[None, :]  # tokens back
_AHEAD = np.where(_AGO < 0, np.float32(-1e4), np.float32(0))
_AGO = np.maximum(_AGO, 0)


def layout(pieces: np.ndarray, sizes: np.ndarray, vocabulary: Vocabulary):
    """Blocks of texts: inputs and targets (blocks x STRIDE), which blocks are blank, and places.

    pieces: subword ids of all texts, one after another, each text closed by the end mark. A
    blank block stands before each text.
    """
    blocks = -(-sizes // STRIDE) + 1
    start = (np.cumsum(blocks) - blocks + 1) * STRIDE
    offset = np.cumsum(sizes) - sizes
    place = np.arange(len(pieces)) + np.repeat(start - offset, sizes)
    total = int(blocks.sum()) * STRIDE
    inputs = np.full(total, vocabulary.blank, np.int32)
    targets = np.full(total, -1, np.int32)
    targets[place] = pieces
    inputs[place[1:]] = vocabulary.inputs[pieces[:-1]]
    inputs[start] = vocabulary.begin
    blank = np.zeros(total // STRIDE, bool)
    blank[start // STRIDE - 1] = True
    return inputs.reshape(-1, STRIDE), targets.reshape(-1, STRIDE), blank, place


_SCALE = np.float32(WIDTH**-0.5)


def _tables(w):
    """Vectors depend on the input alone, so they, keys, values and queries are looked up by input.

    Behind a vector stands a zero, behind a value a one.
    """
    x = w["vectors"]
    none = np.zeros((len(x), 1), x.dtype)
    return np.concatenate((x, none), 1), x @ (w["query"] * _SCALE), x @ w["key"], np.concatenate((x @ w["value"], none + 1), 1)


def _windows(blocks):
    """Each block with the one before it, without a copy."""
    return np.lib.stride_tricks.as_strided(blocks, (len(blocks) - 1, 2 * STRIDE, blocks.shape[2]), blocks.strides)


def _attend(w, tables, bias, inputs, blank, out):
    """Fills out with the hidden vectors, each with a one behind it, of all blocks but the first, which
    only lends its keys and values; returns what the gradient needs of the way there."""
    x, query, key, value = (t.take(inputs[i:], 0) for t, i in zip(tables, (1, 1, 0, 0)))
    s = query @ _windows(key).transpose(0, 2, 1)
    s += bias
    s[blank[:-1], :, :STRIDE] = -1e4
    if s.max(initial=0) > 60:
        np.minimum(s, 60, out=s)
    e = np.exp(s, out=s)
    mixed = e @ _windows(value)  # the ones behind the values add up to the total
    share = 1 / mixed[:, :, WIDTH:]
    mixed *= share
    x += mixed
    h = x.reshape(-1, WIDTH + 1)
    r = h @ w["first"]
    np.maximum(r, 0, out=r)
    np.matmul(r, np.concatenate((w["second"], np.zeros_like(w["second"][:, :1])), 1), out=out)
    out += h
    return query, key, value, e, mixed, share, h, r


def _log_likelihood(w, out, real, before, targets, vocabulary, grad=None):
    """Log probability of each target, whose vectors are rows `real` of out; with grad also fills it and
    returns the gradient of out.

    Tokens are sorted by class, so that one product serves all tokens of a class, for the class and the
    member at once; the rest is done for ROWS tokens at once, which stay in the cache.
    """
    group = vocabulary.group.take(targets)
    order = np.argsort(group.astype(np.int8), kind="stable")
    group, before, targets, real = group.take(order), before.take(order), targets.take(order), real.take(order)
    bounds = np.searchsorted(group, np.arange(CLASSES + 2)).tolist()
    side = CLASSES + 1
    weights = np.empty((side, WIDTH + 1, side + MEMBERS), out.dtype)
    weights[:, :, :side] = w["group"]
    weights[:CLASSES, :, side:] = w["member"]
    weights[CLASSES, :, side:] = 0
    turned = np.ascontiguousarray(weights.transpose(0, 2, 1))
    after, parts = vocabulary.after, _PARTS.astype(out.dtype)
    places = group * np.int64(after.shape[1]) + before
    after = after.reshape(-1, after.shape[2])
    member = side + vocabulary.member.take(targets)
    found = vocabulary.rare.take(targets).astype(out.dtype)
    back = None if grad is None else np.zeros_like(out)
    both = None if grad is None else np.zeros_like(weights)
    width = side + MEMBERS
    for first in range(0, len(order), ROWS):
        last = min(first + ROWS, len(order))
        edges = [min(max(b, first), last) - first for b in bounds]
        common = edges[CLASSES]
        used = [(c, slice(edges[c], edges[c + 1])) for c in range(side) if edges[c] < edges[c + 1]]
        v = out.take(real[first:last], 0)
        z = np.empty((last - first, width), out.dtype)
        for c, at in used:
            np.matmul(v[at], weights[c], out=z[at])
        # The counts give log probabilities; only what the layers add could make a logit large.
        z += after.take(places[first:last], 0)
        if z.max() > 60:
            np.minimum(z, 60, out=z)
        flat, start = z.reshape(-1), np.arange(last - first) * width
        at_group, at_member = start + group[first:last], (start + member[first:last])[:common]
        found[first:last] += flat.take(at_group)
        found[first : first + common] += flat.take(at_member)
        np.exp(z, out=z)
        total = z @ parts
        logs = np.log(total)
        found[first:last] -= logs[:, 0]
        found[first : first + common] -= logs[:common, 1]
        if grad is not None:
            total = 1 / total
            total[common:, 1] = 0
            z *= total @ parts.T
            flat[at_group] -= 1
            flat[at_member] -= 1
            asked = np.empty_like(v)
            for c, at in used:
                both[c] += v[at].T @ z[at]
                np.matmul(z[at], turned[c], out=asked[at])
            back[real[first:last]] = asked
    logp = np.empty_like(found)
    logp[order] = found
    if grad is not None:
        grad["group"] += both[:, :, :side].sum(0)
        grad["member"] += both[:CLASSES, :, side:]
    return logp, back


_PARTS = np.zeros((CLASSES + 1 + MEMBERS, 2), np.float32)
_PARTS[: CLASSES + 1, 0] = 1
_PARTS[CLASSES + 1 :, 1] = 1


def score(flat: np.ndarray, pieces: np.ndarray, sizes: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Natural log probability of each token."""
    if not len(pieces):
        return np.zeros(0)
    w = views(flat)
    inputs, targets, blank, place = layout(pieces, sizes, vocabulary)
    tables, bias = _tables(w), w["distance"][_AGO] + _AHEAD
    logp = np.zeros(targets.size, np.float32)
    hidden = np.empty((BLOCKS * STRIDE, WIDTH + 1), np.float32)
    for first in range(1, len(inputs), BLOCKS):
        last = min(first + BLOCKS, len(inputs))
        for a in range(first, last, ATTEND):
            b = min(a + ATTEND, last)
            _attend(w, tables, bias, inputs[a - 1 : b], blank[a - 1 : b], hidden[(a - first) * STRIDE : (b - first) * STRIDE])
        wanted = targets[first:last].ravel()
        real = np.flatnonzero(wanted >= 0)
        found, _ = _log_likelihood(w, hidden, real, inputs[first:last].ravel().take(real), wanted.take(real), vocabulary)
        logp[first * STRIDE + real] = found
    return logp[place].astype(float)


def gradient(flat, inputs, targets, blank, vocabulary):
    """Mean loss and its gradient over blocks 1 onward."""
    w, flat_grad = views(flat), np.zeros_like(flat)
    g = views(flat_grad)
    tables, bias = _tables(w), w["distance"][_AGO] + _AHEAD
    out = np.empty(((len(inputs) - 1) * STRIDE, WIDTH + 1), flat.dtype)
    parts = [(a, min(a + ATTEND, len(inputs))) for a in range(1, len(inputs), ATTEND)]
    ways = [_attend(w, tables, bias, inputs[a - 1 : b], blank[a - 1 : b], out[(a - 1) * STRIDE : (b - 1) * STRIDE]) for a, b in parts]
    wanted = targets[1:].ravel()
    real = np.flatnonzero(wanted >= 0)
    logp, back = _log_likelihood(w, out, real, inputs[1:].ravel().take(real), wanted.take(real), vocabulary, g)
    first, second = np.ascontiguousarray(w["first"][:WIDTH].T), np.ascontiguousarray(w["second"].T)
    asked = np.zeros((STRIDE, 2 * STRIDE), flat.dtype)
    # Of vector, query, key and value as looked up, side by side, and from there back to the vectors.
    home = np.concatenate((np.eye(WIDTH, dtype=flat.dtype), w["query"].T * _SCALE, w["key"].T, w["value"].T))
    looked = np.zeros((WIDTH, 4 * WIDTH), flat.dtype)
    ids = np.concatenate([inputs[a - 1 : b].ravel() for a, b in parts] or [inputs.ravel()]).astype(np.int64)
    lines, done = np.zeros((WIDTH, len(ids)), flat.dtype), 0
    for (a, b), (query, key, value, e, mixed, share, h, r) in zip(parts, ways):
        d_out = back[(a - 1) * STRIDE : (b - 1) * STRIDE, :WIDTH]
        g["second"] += r.T @ d_out
        du = d_out @ second
        du *= r > 0
        g["first"] += h.T @ du
        d = np.zeros((b - a + 1, STRIDE, 4 * WIDTH), flat.dtype)
        dh = (du @ first + d_out).reshape(b - a, STRIDE, WIDTH)
        d[1:, :, :WIDTH] = dh
        scaled = np.empty_like(mixed)
        np.multiply(dh, share, out=scaled[:, :, :WIDTH])
        scaled[:, :, WIDTH] = -np.einsum("bij,bij->bi", scaled[:, :, :WIDTH], mixed[:, :, :WIDTH])
        ds = scaled @ _windows(value).transpose(0, 2, 1)
        ds *= e
        asked += ds.sum(0)
        np.matmul(ds, _windows(key), out=d[1:, :, WIDTH : 2 * WIDTH])
        # Keys and values of a block are asked by itself and by the next one.
        for asks, of, at in ((ds, query, 2 * WIDTH), (e, scaled[:, :, :WIDTH], 3 * WIDTH)):
            asks = asks.transpose(0, 2, 1)
            np.matmul(asks[:, STRIDE:], of, out=d[1:, :, at : at + WIDTH])
            d[:-1, :, at : at + WIDTH] += asks[:, :STRIDE] @ of
        d = d.reshape(-1, 4 * WIDTH)
        mine = slice(done, done + len(d))
        looked += w["vectors"].take(ids[mine], 0).T @ d
        np.matmul(home.T, d.T, out=lines[:, mine])
        done += len(d)
    g["distance"] += np.bincount(_AGO[_AHEAD == 0], asked[_AHEAD == 0], 2 * STRIDE).astype(flat.dtype)
    _, dq, dk, dv = np.split(looked, 4, 1)
    g["query"] += dq * _SCALE
    g["key"] += dk
    g["value"] += dv
    for i, line in enumerate(lines):
        g["vectors"][:, i] += np.bincount(ids, line, len(w["vectors"]))
    g["vectors"][vocabulary.blank] = 0
    n = max(len(real), 1)
    flat_grad /= n
    return -float(logp.sum()) / n, flat_grad


def train(flat: np.ndarray, batches, vocabulary: Vocabulary, rate: float) -> tuple[np.ndarray, int, float]:
    """Adam over batches of (pieces, sizes); returns the weights, tokens seen and mean loss."""
    flat = flat.copy()
    m, v = np.zeros_like(flat), np.zeros_like(flat)
    tokens, loss, t = 0, 0.0, 0
    for pieces, sizes in batches:
        if not len(pieces):
            continue
        inputs, targets, blank, _ = layout(pieces, sizes, vocabulary)
        value, g = gradient(flat, inputs, targets, blank, vocabulary)
        t += 1
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        flat -= rate * min(1, t / 10) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        tokens += len(pieces)
        loss += value * len(pieces)
    return flat, tokens, loss / max(tokens, 1)
