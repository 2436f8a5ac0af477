"""LM scoring by online logistic context mixing.

A text (A-Z lower-cased) is predicted bit by bit, most significant first, each
byte and an end symbol 0.  For every order in ORDERS, the last so many bytes
and the bits known of the next byte are a context, whose counts of zeros and
ones over the whole training corpus predict the bit.  The stretched predictions
are combined by a logistic mixer whose weight set is gated by how many contexts
were met and the bit's place; an adaptive probability map over the byte's known
bits then refines the mixed probability.

Counts are exact and grow with the corpus: each chunk asks its distinct codes
(context bytes and symbol) of every order with their training counts, a bucket
of the context's hash adds them up and answers the predictions, with and
without the asking occurrence.  Weights and map are learned in tasks over every
training text: in each of ROUNDS each chunk goes online through its distinct
codes, weighted by how often they occur, from the last round's state, and the
chunks' states are averaged by what each has seen (in integers, so that the
order of the sums does not matter).

Defined results: null text is empty (its end is still scored); without any
training text every bit has probability 1/2; a null id is in training (its
remainder is not the held-out one); repeated rows count as often as they
occur; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basinflow.llm import exchange as X
from basinflow.llm import textops as T
from basinflow.llm.store import cut

ORDERS = (1, 2, 3, 4, 5)
ROUNDS = 2                   # passes over all training chunks
STEP_CODES = 4096            # distinct codes of one online step
FIXED = float(1 << 20)       # parts of one in sums of states
STATE_PARTS = 8
MAP_CELLS = 33               # cells of the probability map over the stretched probability
MAP_REACH = 8.0
LEAST_P = 1 / 65536
UNIT = 12
LEVEL = 6                    # of the compression of what chunks and buckets send
_NODE = np.uint64(0x9E3779B97F4A7C15)
LOG10_2 = float(np.log10(2.0))


def contexts(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One code for each byte and end: its context bytes, then the symbol;
    and how many codes each document has."""
    reach = max(ORDERS)
    n = np.diff(offs) + 1
    # Each text is led by zero bytes (no context yet) and followed by its end.
    last = np.cumsum(n + reach) - 1
    lead = ((last - n - reach + 1)[:, None] + np.arange(reach)).ravel()
    real = np.ones(int((n + reach).sum()), bool)
    real[lead] = False
    out = np.zeros(len(real) + 8, np.uint8)
    real[last] = False
    out[:len(real)][real] = T.lower_ascii(data)
    real[last] = True
    lane = np.ndarray((len(real) - reach,), ">u8", out, strides=(1,)) if len(real) else np.zeros(0, ">u8")
    code = lane.astype(np.uint64)[real[reach:]]
    return code >> np.uint64(64 - 8 * (reach + 1)), n


def _node(code, bit):
    return np.uint64(1 << bit) | ((code & np.uint64(255)) >> np.uint64(8 - bit))


def _stretched(zeros, ones) -> np.ndarray:
    """Logarithm of the odds of a one in steps of 1 / UNIT; 0 where it was never
    met."""
    odds = np.log((ones + np.float32(0.4)) / (zeros + np.float32(0.4)))
    return np.clip(np.rint(odds * UNIT), -127, 127).astype(np.int8)


GATES = 8 * (len(ORDERS) + 1)


@dataclass
class Mixer:
    weights: np.ndarray                     # (order, gate), for steps of 1 / UNIT
    bias: np.ndarray
    map: np.ndarray                         # (known bits, cell)

    def mixed(self, st: np.ndarray, met: np.ndarray, bit: int):
        """Mixed stretched predictions: all weight sets of the bit at once, of
        which each code's number of met contexts takes one."""
        z = self.weights[:, bit::8].T @ st
        z += self.bias[bit::8, None]
        z = z.ravel()[met * len(met) + np.arange(len(met))]
        return np.clip(z, -MAP_REACH + 1e-3, MAP_REACH - 1e-3, out=z)

    def cells(self, z):
        at = (z + np.float32(MAP_REACH)) * np.float32((MAP_CELLS - 1) / (2 * MAP_REACH))
        low = at.astype(np.int64)
        return low, at - low.astype(at.dtype)

    def refined(self, z, node):
        low, part = self.cells(z)
        low += node * MAP_CELLS
        flat = self.map.ravel()
        a = flat[low]
        p = a + (flat[low + 1] - a) * part
        p += 1 / (1 + np.exp(-z))
        p *= 0.5
        return np.clip(p, LEAST_P, 1 - LEAST_P, out=p)

    def log2_codes(self, code: np.ndarray, stretched) -> np.ndarray:
        """log2 of the probability of each code's symbol; ``stretched(part)``
        has, bit by bit, the orders' predictions for a part of the codes."""
        out = np.zeros(len(code))
        for i in range(0, len(code), 1 << 14):
            part = slice(i, i + (1 << 14))
            c = code[part]
            for bit, st in enumerate(stretched(part)):
                p = self.refined(self.mixed(st, met_of(st), bit), _node(c, bit).view(np.int64))
                one = (c >> np.uint64(7 - bit)) & np.uint64(1) == 1
                out[part] += np.log2(np.where(one, p, 1 - p))
        return out

    def step(self, code: np.ndarray, times: np.ndarray, stretched, turn: int, rate: float, map_rate: float,
             seen: np.ndarray, cell_seen: np.ndarray) -> None:
        """Move weights and map by one set of codes, each met ``times`` often;
        add what every gate and cell met."""
        slow = 1 / (1 + turn / 50)
        flat, sets = self.map.reshape(-1), np.arange(len(ORDERS) + 1)
        for bit, st in enumerate(stretched):
            one = ((code >> np.uint64(7 - bit)) & np.uint64(1)).astype(np.int64)
            met = met_of(st)
            z = self.mixed(st, met, bit)
            err = (one - 1 / (1 + np.exp(-z))) * times
            mine = (met == sets[:, None]).astype(np.float64)            # the bit's gates are ``sets`` * 8 + bit
            got = mine @ np.concatenate([st * err, [err, times]]).T
            here = got[:, -1]
            seen[bit::8] += here
            got = got[:, :-1] * (rate * max(slow, 0.1) / np.maximum(here, 16))[:, None]
            self.weights[:, bit::8] += got[:, :-1].T / UNIT ** 2
            self.bias[bit::8] += got[:, -1]
            # Only the cells of nodes with so many known bits are met.
            first, many = (1 << bit) * MAP_CELLS, (1 << bit) * MAP_CELLS
            cells = flat[first:first + many]
            low, part = self.cells(z)
            low += _node(code, bit).view(np.int64) * MAP_CELLS - first
            low *= 2
            low += one
            part *= times
            met = np.bincount(low, times - part, 2 * many)
            met += np.bincount(low + 2, part, 2 * many)
            size = met[::2] + met[1::2]
            cell_seen[first:first + many] += size
            cells += map_rate * max(slow, 0.05) * (met[1::2] - size * cells) / np.maximum(size, 8)


def start() -> Mixer:
    cells = 1 / (1 + np.exp(-np.linspace(-MAP_REACH, MAP_REACH, MAP_CELLS)))
    return Mixer(np.full((len(ORDERS), GATES), 0.3 / UNIT), np.zeros(GATES), np.tile(cells, (256, 1)))


def met_of(st: np.ndarray) -> np.ndarray:
    """How many contexts of each code were met; with the bit's place, the gate."""
    return np.count_nonzero(st, 0)


def single(m: Mixer) -> Mixer:
    m.weights, m.bias, m.map = (x.astype(np.float32) for x in (m.weights, m.bias, m.map))
    return m


# Counts of codes: asked by chunks, added up and answered by buckets.

def _planes(x: np.ndarray) -> bytes:
    """Bytes of equal place side by side: sorted codes compress well so."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _packed(b: bytes) -> bytes:
    return len(b).to_bytes(4, "little") + pa.Codec("zstd", compression_level=LEVEL).compress(b, asbytes=True)


def _expanded(b) -> bytes:
    return pa.decompress(b[4:], int.from_bytes(b[:4], "little"), "zstd", asbytes=True)


def _unplanes(b, kind: str, n: int, at: int = 0) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8, size * n, at).reshape(size, n).T).view(kind).ravel()


def _contexts(b: X.Batch):
    """(first row, last row, codes, how many each row has) of slices of a chunk."""
    for i, j in T.slices(b.offs, 1 << 20):
        yield i, j, *contexts(b.data[b.offs[i]:b.offs[j]], b.offs[i:j + 1] - b.offs[i])


def distinct_codes(b: X.Batch, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes of a chunk and how often training rows have each."""
    codes, times = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for i, j, code, n in _contexts(b):
        flagged = np.sort(code << np.uint64(1) | np.repeat(train[i:j] != 0, n).astype(np.uint64))
        first = np.flatnonzero(np.concatenate([[True], flagged[1:] != flagged[:-1]]))
        flagged, often = flagged[first], np.diff(first, append=len(flagged))
        codes.append(flagged >> np.uint64(1))
        times.append(often * (flagged & np.uint64(1)).view(np.int64))
    code, inv = np.unique(np.concatenate(codes), return_inverse=True)
    return code, np.bincount(inv, np.concatenate(times), len(code)).astype("<u4")


def sums(b: X.Batch, distinct: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Sum over each text of ``logs``, one for each of the sorted distinct codes."""
    bits = np.uint64(64 - len(distinct).bit_length() - 2)
    table = np.zeros(1 << 64 - int(bits), np.int32)
    table[((distinct * _NODE) >> bits).view(np.int64)] = np.arange(len(distinct))
    out = [np.zeros(0)]
    for _, _, code, n in _contexts(b):
        at = table[((code * _NODE) >> bits).view(np.int64)]
        miss = np.flatnonzero(distinct[at] != code)
        at[miss] = np.searchsorted(distinct, code[miss])
        out.append(np.add.reduceat(logs[at], np.cumsum(n) - n, dtype=np.float64))
    return np.concatenate(out)


def _keys(code: np.ndarray, buckets: int):
    """Distinct keys (order, context, symbol) of sorted codes by bucket, their
    buckets, and for each order the key number of each code."""
    keys, at, base = [np.zeros(0, np.uint64)], [], 0
    for o in ORDERS:
        if o == max(ORDERS):                            # the codes themselves
            distinct, inv = code, np.arange(len(code))
        else:
            distinct, inv = np.unique(code & np.uint64((1 << 8 * (o + 1)) - 1), return_inverse=True)
        keys.append(distinct | np.uint64(o << 56))
        at.append(inv + base)
        base += len(distinct)
    keys = np.concatenate(keys)
    bucket = X.bucket_of(T.mix64((keys >> np.uint64(8)) * _NODE), buckets)
    if buckets <= 1 << 16:
        bucket = bucket.astype(np.uint16)               # sorted by radix
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return keys[order], bucket[order], [place[x] for x in at]


def _key_times(at: list[np.ndarray], often: np.ndarray, n: int) -> np.ndarray:
    """How often training rows of the chunk have each key."""
    times = np.zeros(n, np.int64)
    for x in at:
        times += np.bincount(x, often, n).astype(np.int64)
    return times


def _ask_codes(code: np.ndarray, often: np.ndarray, buckets: int):
    """(bucket, keys and their training counts)."""
    keys, bucket, at = _keys(code, buckets)
    times = _key_times(at, often, len(keys)).astype("<u4")
    for k, i, j in X.by_bucket(bucket):
        yield k, _packed(_planes(keys[i:j].astype("<u8")) + _planes(times[i:j]))


def _predictions(keys: np.ndarray, total: np.ndarray) -> np.ndarray:
    """For sorted distinct keys with all the keys of their contexts: the eight
    bits' stretched predictions, and what they lose without one occurrence of
    the key (16 rows)."""
    out = np.zeros((16, len(keys)), np.int8)
    if not len(keys):
        return out
    for bit in range(8):
        node = keys >> np.uint64(8 - bit)
        new = node[1:] != node[:-1]
        first = np.flatnonzero(np.concatenate([[True], new]))
        run = np.cumsum(np.concatenate([[0], new]))
        one = ((keys >> np.uint64(7 - bit)) & np.uint64(1)).astype(np.int64)
        ones = np.add.reduceat(total * one, first)[run]
        zeros = np.add.reduceat(total, first)[run] - ones
        out[bit] = _stretched(zeros, ones)
        out[8 + bit] = _stretched(np.maximum(zeros - (1 - one), 0), np.maximum(ones - one, 0)) - out[bit]
    return out


def _code_counts(blobs: list[bytes]) -> list[bytes]:
    """For each chunk's keys: a bit that says that no other chunk asked for a
    key of the context (the chunk then knows all its counts itself), and the
    predictions of the other keys."""
    blobs = [_expanded(x) for x in blobs]
    n = [len(x) // 12 for x in blobs]
    keys = np.concatenate([_unplanes(x, "<u8", k) for x, k in zip(blobs, n, strict=True)])
    times = np.concatenate([_unplanes(x, "<u4", k, 8 * k) for x, k in zip(blobs, n, strict=True)])
    distinct, inv = np.unique(keys, return_inverse=True)
    chunk = np.repeat(np.arange(len(n)), n)
    context = np.concatenate([[0], np.cumsum((distinct[1:] ^ distinct[:-1]) >> np.uint64(8) != 0)])[inv]
    some = np.zeros(len(distinct), np.int64)
    some[context] = chunk
    shared = np.bincount(context, some[context] != chunk, len(distinct)) > 0
    asked = shared[context]
    wanted = np.zeros(len(distinct), bool)
    wanted[inv[asked]] = True
    total = np.bincount(inv, times, len(distinct)).astype(np.int64)
    got = np.zeros((16, len(distinct)), np.int8)
    got[:, wanted] = _predictions(distinct[wanted], total[wanted])
    cuts = np.cumsum(n)[:-1]
    return [_packed(np.packbits(x).tobytes() + got[:, k[x]].tobytes())
            for x, k in zip(np.split(asked, cuts), np.split(inv, cuts), strict=True)]


class Known:
    """A chunk's codes with the answered predictions of every order and bit."""

    def __init__(self, note, replies, sizes, buckets: int):
        note = _expanded(note)
        n = len(note) // 12
        self.code, self.times = _unplanes(note, "<u8", n), _unplanes(note, "<u4", n, 8 * n)
        keys, bucket, self.at = _keys(self.code, buckets)
        got, own, i = np.zeros((16, len(keys)), np.int8), np.ones(len(keys), bool), 0
        for (_, a, b), size in zip(X.by_bucket(bucket), sizes, strict=True):
            x = np.frombuffer(_expanded(replies[i:i + size]), np.uint8)
            head = -(-(b - a) // 8)
            asked = a + np.flatnonzero(np.unpackbits(x[:head], count=b - a))
            own[asked] = False
            got[:, asked] = x[head:].view(np.int8).reshape(16, -1)
            i += size
        own = np.flatnonzero(own)
        own = own[np.argsort(keys[own], kind="stable")]
        got[:, own] = _predictions(keys[own], _key_times(self.at, self.times, len(keys))[own])
        self.all = np.ascontiguousarray(got[:8].T).view(np.uint64).ravel()
        self.rest = np.ascontiguousarray((got[:8] + got[8:]).T).view(np.uint64).ravel()

    def _of(self, packed, part):
        st = np.stack([packed[x[part]] for x in self.at]).view(np.int8).reshape(len(ORDERS), -1, 8)
        return np.ascontiguousarray(st.transpose(2, 0, 1), np.float32)

    def full(self, part) -> np.ndarray:
        return self._of(self.all, part)

    def apart(self, part) -> np.ndarray:
        """Predictions without the occurrence that is predicted."""
        return self._of(self.rest, part)

    def learn(self, state: Mixer, turn: int, rate: float = 0.15, map_rate: float = 0.3) -> np.ndarray:
        """State sums, in parts of 1 / FIXED, of one online pass from ``state``."""
        m = Mixer(state.weights.copy(), state.bias.copy(), state.map.copy())
        seen, cell_seen = np.zeros(GATES), np.zeros(m.map.size)
        mine = np.flatnonzero(self.times)
        mine = mine[np.argsort(T.mix64(self.code[mine] ^ np.uint64(turn + 1)), kind="stable")]
        steps = max(1, -(-len(mine) // STEP_CODES))
        for k in range(steps):
            part = mine[k * STEP_CODES:(k + 1) * STEP_CODES]
            m.step(self.code[part], self.times[part].astype(np.float64), self.apart(part),
                   turn * steps + k, rate, map_rate, seen, cell_seen)
        return np.rint(np.concatenate([seen, cell_seen, (m.weights * seen).ravel(), m.bias * seen,
                                       m.map.ravel() * cell_seen]) * FIXED).astype(np.int64)


def _averaged(state: Mixer, total: np.ndarray) -> Mixer:
    """States weighted by what each gate and cell has seen; one that nothing
    was seen of stays."""
    total = total / FIXED
    sizes = [GATES, state.map.size, state.weights.size, GATES, state.map.size]
    seen, cell_seen, weights, bias, cells = np.split(total, np.cumsum(sizes)[:-1])
    div = np.maximum(seen, 1 / FIXED)
    return Mixer(np.where(seen > 0, weights.reshape(state.weights.shape) / div, state.weights),
                 np.where(seen > 0, bias / div, state.bias),
                 np.where(cell_seen > 0, cells / np.maximum(cell_seen, 1 / FIXED), state.map.ravel()).reshape(state.map.shape))


GATHERED = "chunk int, words binary, note binary, replies binary, sizes array<long>"


def _known(b: pa.RecordBatch, buckets: int):
    for k in range(b.num_rows):
        yield Known(b.column("note")[k].as_py(), b.column("replies")[k].as_py(), b.column("sizes")[k].as_py(), buckets)


def fit(gathered: DataFrame, buckets: int, rounds: int = ROUNDS) -> Mixer:
    """Weights and map learned over all chunks of ``gathered``."""
    state = start()
    for turn in range(rounds):
        def learn(batches, state=state, turn=turn):
            total = np.zeros(0, np.int64)
            for b in batches:
                for known in _known(b, buckets):
                    got = known.learn(state, turn)
                    total = total + got if len(total) else got
            if len(total):
                cuts = np.array_split(total.astype("<i8"), STATE_PARTS)
                yield pa.RecordBatch.from_pydict({"part": pa.array(range(STATE_PARTS), pa.int32()), "state": [x.tobytes() for x in cuts]})

        def add(table: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(x.as_buffer(), "<i8") for x in table.column("state"))
            return pa.table({"part": table.column("part").slice(0, 1), "state": [total.tobytes()]})

        schema = "part int, state binary"
        rows = gathered.mapInArrow(learn, schema).groupBy("part").applyInArrow(add, schema).collect()    # STATE_PARTS rows
        if rows:
            state = _averaged(state, np.concatenate([np.frombuffer(r["state"], "<i8") for r in sorted(rows, key=lambda r: r["part"])]))
    return single(state)


# The base: counts of words over the training rows.

def _ask_words(b: X.Batch, train: np.ndarray, buckets: int):
    low = T.lower_ascii(b.data)
    s, e, first = T.words(low, b.offs)
    h = T.hash_spans(low, s, e)
    distinct, inv = np.unique(h, return_inverse=True)
    times = np.bincount(inv, train[T.rows_of(np.diff(first))], len(distinct)).astype("<u4")
    bucket = X.bucket_of(distinct, buckets)
    order = np.argsort(bucket, kind="stable")
    return first, inv, distinct[order], times[order], bucket[order], order


def _word_counts(blobs: list[bytes]) -> list[bytes]:
    n = [len(x) // 12 for x in blobs]
    hashes = np.concatenate([np.frombuffer(x, "<u8", k) for x, k in zip(blobs, n, strict=True)])
    times = np.concatenate([np.frombuffer(x, "<u4", offset=8 * k) for x, k in zip(blobs, n, strict=True)])
    distinct, inv = np.unique(hashes, return_inverse=True)
    total = np.bincount(inv, times, len(distinct)).astype("<i8")
    facts = np.array([(total > 0).sum(), total.sum()], "<i8").tobytes()
    return [part.tobytes() for part in np.split(total[inv], np.cumsum(n)[:-1])] + [facts]


def _answer(asked: DataFrame, buckets: int) -> DataFrame:
    """Word counts (buckets below ``buckets``) and predictions of codes (the
    others) for each chunk; one row of chunk -1 a word bucket with its distinct
    training words and their total; a chunk's notes pass."""
    def respond(table: pa.Table) -> pa.Table:
        bucket, blobs = table.column("bucket")[0].as_py(), table.column("blob").to_pylist()
        if bucket < 0:
            return table
        if bucket >= buckets:
            return table.set_column(2, "blob", pa.array(_code_counts(blobs), pa.binary()))
        *replies, facts = _word_counts(blobs)
        return pa.table({"chunk": pa.array(table.column("chunk").to_pylist() + [-1], pa.int32()),
                         "bucket": pa.array([bucket] * (len(replies) + 1), pa.int32()),
                         "blob": pa.array([*replies, facts], pa.binary())})
    return asked.groupBy("bucket").applyInArrow(respond, X.ROWS)


def _gather(buckets: int):
    """One row a chunk: its answers in the order of their buckets."""
    def gather(table: pa.Table) -> pa.Table:
        table = table.sort_by("bucket")
        bucket, blob = table.column("bucket").to_numpy(), table.column("blob").to_pylist()
        low, high = np.searchsorted(bucket, [0, buckets]).tolist()
        return pa.table({"chunk": table.column("chunk").slice(0, 1), "words": pa.array([b"".join(blob[low:high])], pa.binary()),
                         "note": pa.array([b"".join(blob[:low])], pa.binary()), "replies": pa.array([b"".join(blob[high:])], pa.binary()),
                         "sizes": pa.array([[len(x) for x in blob[high:]]], pa.list_(pa.int64()))})
    return gather


SCORES = "doc_id long, n_words long, known_words long, word_logs double, n_bytes long, bits double"


def score(docs: DataFrame, training: Column, is_training, id_col="doc_id", text_col="text", **sizes) -> DataFrame:
    """One row per document with the base's and the model's scores.

    ``training`` marks the training rows of ``docs``; ``is_training(ids)`` is
    the same rule over an array of ids (NO_ID for null)."""
    c = X.chunked(docs, id_col, text_col, packed=True, **sizes)
    buckets = c.buckets

    def ask(b: X.Batch):
        train = is_training(b.id)
        _, _, distinct, times, bucket, _ = _ask_words(b, train, buckets)
        for k, i, j in X.by_bucket(bucket):
            yield k, distinct[i:j].astype("<u8").tobytes() + times[i:j].tobytes()
        code, often = distinct_codes(b, train)
        yield X.note(b.chunk), _packed(_planes(code.astype("<u8")) + _planes(often))
        for k, blob in _ask_codes(code, often, buckets):
            yield buckets + k, blob

    gathered = cut(_answer(c.ask(ask), buckets).groupBy("chunk").applyInArrow(_gather(buckets), GATHERED), "contexts")
    facts = gathered.where("chunk = -1").select("words").collect()       # one row, 16 bytes a bucket
    x = np.frombuffer(facts[0]["words"] if facts else b"", "<i8").reshape(-1, 2)
    v, n = int(x[:, 0].sum()), int(x[:, 1].sum())
    chunks = gathered.where("chunk >= 0")
    model = docs.sparkSession.sparkContext.broadcast(fit(chunks, buckets))

    def logs(batches):
        for b in batches:
            out = [w.as_py() + _packed(_planes(k.code) + _planes(model.value.log2_codes(k.code, k.full).astype("<f4")))
                   for w, k in zip(b.column("words"), _known(b, buckets), strict=True)]
            yield pa.RecordBatch.from_pydict({"chunk": b.column("chunk"), "bucket": pa.array([0] * len(out), pa.int32()),
                                              "blob": pa.array(out, pa.binary())})

    def use(b: X.Batch, replies: dict[int, bytes]) -> pa.Table:
        first, inv, distinct, _, _, order = _ask_words(b, np.zeros(len(b.id)), buckets)
        blob = replies[0]
        codes = _expanded(blob[8 * len(distinct):])
        m = len(codes) // 12
        total = np.zeros(len(distinct), np.int64)
        total[order] = np.frombuffer(blob, "<i8", len(distinct))
        bits = -sums(b, _unplanes(codes, "<u8", m), _unplanes(codes, "<f4", m, 8 * m))
        seen = total[inv]
        row, n = T.rows_of(np.diff(first)), len(b.id)
        return pa.table({"doc_id": b.ids, "n_words": pa.array(np.diff(first), pa.int64()),
                         "known_words": pa.array(np.bincount(row, seen > 0, n).astype(np.int64)),
                         "word_logs": pa.array(np.bincount(row, np.log10(seen + 1.0), n)),
                         "n_bytes": pa.array(np.diff(b.offs), pa.int64()), "bits": pa.array(bits)})

    ends = docs.where(training).count()
    n, v = n + ends, v + (ends > 0)
    out = c.with_answers(chunks.mapInArrow(logs, X.ROWS), use, SCORES)
    norm = float(np.log10(float(n + v + 1)))
    tokens = F.col("n_words") + 1
    return out.select(
        "doc_id", tokens.alias("n_tokens"), (F.col("known_words") + (1 if ends else 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("word_logs") + float(np.log10(ends + 1.0)) - tokens * norm).alias("base_score"),
        (F.col("bits") * -LOG10_2).alias("score"), "bits", (F.col("bits") / (F.col("n_bytes") + 1)).alias("bits_per_byte"))
