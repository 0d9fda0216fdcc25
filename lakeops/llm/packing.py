"""Best-fit packing of token pieces into sequences of fixed capacity.

The pieces' length histogram (at most ``capacity`` numbers, whatever the
corpus) is packed by the configuration linear program: a configuration is a multiset of
lengths that fits one sequence, and the program covers every length's count by as
little configuration as possible. It is solved by multiplicative weights. A length's dual
price is its share of the capacity times exp(-RATE * how far it is covered beyond the
average), over all lengths still open. A knapsack dynamic program finds, in one run for
all capacities, the dearest configuration and the dearest one that holds a given length; each
step adds those of the least covered lengths that are within SLACK of the dearest, DELTA
of a length's count at a time. Prices that no configuration exceeds prove a lower bound.

The amounts are rounded down, to the nearest, and up as far as pieces last, the rest
is packed best-fit decreasing; where that stays more than GAP above the bound, the program
is solved again for what rounding down and one rounding up leave, over and over (at most
PRICINGS knapsacks). The plan with the fewest sequences is taken, plain best-fit decreasing
among them, so the program never does worse than that.

Every piece then finds its place by its rank among the pieces of its length:
ranks come from a distributed numbering, the plan is a table whose size is
bounded by the capacity, ``STEPS`` and ``PRICINGS``.

Ids are those of the byte-level BPE file: its vocabulary is read as byte ranks
and encoded by tiktoken, which gives the ids that the tokenizers library gives
(tests compare them) in a fraction of its time; long texts are encoded in parts,
cut before a space between two letters, where a token always begins.

Defined cases: a NULL or empty text is the one closing id; a NULL doc_id is an
id like any other; repeated rows are packed each; an empty table gives no
rows; texts over the capacity alone are cut."""

from __future__ import annotations

import json
import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import give_back, numbered, written

CAPACITY = 2048
CLOSING_ID = 0
STEPS = 1500            # most runs of the knapsack in one solution
BATCH = 64              # lengths whose configuration one run prices
RATE = 5.0              # how fast a price falls with coverage
DELTA = 0.05            # of a length's count, covered at a time
SLACK = 0.05            # that a configuration may cost less than the dearest
PRICINGS = 1500         # most runs of the knapsack to round by solving again
GAP = 0.0005            # above the proven bound from which that is tried
BUCKETS = 256           # parts of one length's pieces that are numbered apart
PART_CHARS = 1 << 16
_CUT = re.compile(r"(?<=[^\W\d_])(?= [^\W\d_])")
# Fixed value: the split pattern of this byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# ---------------------------------------------------------------- ids

def byte_of_char() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for:
    printable bytes are themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def encoder(path: str):
    """The encoder of a byte-level BPE file: text -> ids, no special tokens."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    of = byte_of_char()
    ranks = {bytes(of[c] for c in token): i for token, i in vocab.items()}
    return tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, size: int = PART_CHARS):
    """``text`` cut where a token begins, into parts of about ``size``."""
    at = 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def ids_of(coder, text: str | None) -> np.ndarray:
    out = [coder.encode_ordinary(p) for p in parts(text)] if text else []
    return np.array([i for p in out for i in p] + [CLOSING_ID], dtype="<u4")


def cut_points(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; the first may be shorter."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of ``docs`` (doc_id, text)."""
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches):
        coder = encoder(tokenizer)
        for pdf in batches:
            rows = []
            for doc, text in zip(pdf["doc_id"].astype("Int64"), pdf["text"]):
                ids = ids_of(coder, text)
                for k, (s, n) in enumerate(cut_points(len(ids), capacity)):
                    own = ids[s:s + n]
                    rows.append([doc, k, s, n, zlib.crc32(own.tobytes())] + [own.astype(np.int32)] * with_ids)
            yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})
        give_back()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, schema)


# ---------------------------------------------------------------- the program

def knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(best, last): the largest price of a multiset of the sorted ``lengths``
    within each capacity, and the length put in last (-1: room stays)."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fitting = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c], k = best[c - 1], fitting[c]
        if k:
            found = best[c - lengths[:k]] + prices[:k]
            j = int(found.argmax())
            if found[j] > best[c] * (1 + 1e-12):
                best[c], last[c] = found[j], j
    return best, last


def dearest(lengths: np.ndarray, last: np.ndarray, counts, capacity: int, first: int,
            order: np.ndarray) -> dict[int, int]:
    """The dearest configuration {index: copies} that holds ``first``, read
    from the knapsack. Copies beyond a length's count make way for the lengths
    first in ``order`` that fit."""
    config, room, c = {first: 1}, capacity - int(lengths[first]), capacity - int(lengths[first])
    while c > 0:
        j = int(last[c])
        if j < 0:
            c -= 1
            continue
        if config.get(j, 0) < counts[j]:
            config[j] = config.get(j, 0) + 1
            room -= int(lengths[j])
        c -= int(lengths[j])
    if room >= lengths[0]:
        for j in order[order < np.searchsorted(lengths, room, side="right")].tolist():
            n = min(int(counts[j]) - config.get(j, 0), room // int(lengths[j]))
            if n > 0:
                config[j] = config.get(j, 0) + n
                room -= n * int(lengths[j])
    return config


def best_fit(lengths, left, capacity: int) -> dict[int, int]:
    """The configuration of best-fit decreasing: the longest length left, then
    again and again the longest that still fits."""
    out, room = {}, capacity
    for i in range(len(lengths) - 1, -1, -1):
        n = min(left[i], room // lengths[i])
        if n:
            out[i] = n
            room -= n * lengths[i]
    return out


@dataclass
class Program:
    """A solution of the covering program: amounts of configurations (as sorted
    (index, copies) pairs), their sum, the proven lower bound, and the runs of the knapsack."""
    amounts: dict[tuple, float]
    value: float
    bound: float
    runs: int


def solve(lengths: list[int], counts: list[int], capacity: int, most: int = STEPS) -> Program:
    """The configuration program by multiplicative weights."""
    length, count = np.array(lengths), np.array(counts, dtype=float)
    part, covered, amounts = length / capacity, np.zeros(len(length)), {}
    bound, runs, every = 0.0, 0, np.arange(len(length))
    while runs < most and (covered < 1).any():
        runs += 1
        free = covered < 1
        prices = np.where(free, part * np.exp(-RATE * (covered - covered[free].mean())), 0)
        best, last = knapsack(length, prices, capacity)
        bound = max(bound, float(count @ prices) / best[capacity])
        order = np.argsort(-prices / part, kind="stable")
        added = False
        for i in every[np.argsort(covered, kind="stable")][:BATCH].tolist():
            if covered[i] >= 1:
                break
            config = dearest(length, last, np.where(covered < 1, count, 0), capacity, i, order)
            own, copies = list(config), np.array(list(config.values()), dtype=float)
            if added and prices[own] @ copies < (1 - SLACK) * best[capacity]:
                continue
            room = (count[own] / copies)
            amount = min(DELTA * room.min(), ((1 - covered[own]) * room).min())
            covered[own] += amount * copies / count[own]
            covered[covered > 1 - 1e-9] = 1
            key = tuple(sorted(config.items()))
            amounts[key] = amounts.get(key, 0.0) + amount
            added = True
    scale = 1 / max(covered.min(initial=1), 1e-12)
    amounts = {k: a * scale for k, a in amounts.items()}
    return Program(amounts, sum(amounts.values()), bound, runs)


class _Packing:
    """A plan in the making: configurations used, and the counts left."""

    def __init__(self, lengths: list[int], counts: list[int], capacity: int):
        self.lengths, self.left, self.capacity, self.used = lengths, list(counts), capacity, []

    def use(self, config: dict[int, int], most: int) -> bool:
        m = min([most, *(self.left[i] // n for i, n in config.items())])
        if m <= 0:
            return False
        for i, n in config.items():
            self.left[i] -= m * n
        self.used.append((config, m))
        return True

    def finish(self) -> list[tuple[dict[int, int], int]]:
        """What is left by best-fit decreasing; lengths instead of indexes."""
        while any(self.left):
            self.use(best_fit(self.lengths, self.left, self.capacity), max(self.left))
        return [({self.lengths[i]: n for i, n in c.items()}, m) for c, m in self.used]


def _sequences(configs) -> int:
    return sum(m for _, m in configs)


def _room(lengths, config, capacity: int) -> int:
    return capacity - sum(lengths[i] * n for i, n in config)


def _dive(lengths: list[int], counts: list[int], capacity: int, program: Program) -> list:
    """Round down, the largest amount up, and solve again for the rest."""
    p, own, runs = _Packing(lengths, counts, capacity), list(range(len(lengths))), 0
    while program.amounts:
        took = False
        rows = sorted(program.amounts.items(), key=lambda r: (-r[1], _room([lengths[i] for i in own], r[0], capacity), r[0]))
        for k, (config, amount) in enumerate(rows):
            took |= p.use({own[i]: n for i, n in config}, max(math.floor(amount + 1e-9), k == 0))
        own = [i for i, n in enumerate(p.left) if n]
        if not took or not own or runs >= PRICINGS:
            break
        program = solve([lengths[i] for i in own], [p.left[i] for i in own], capacity, min(STEPS, PRICINGS - runs))
        runs += program.runs
    return p.finish()


def planned(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[dict[int, int], int]], Program]:
    """The plan, and the program's solution beside it."""
    lengths = sorted(n for n in histogram if histogram[n])
    counts = [histogram[n] for n in lengths]
    if not lengths:
        return [], Program({}, 0.0, 0.0, 0)
    program = solve(lengths, counts, capacity)
    plans = [_Packing(lengths, counts, capacity).finish()]
    for up in (1e-9, 0.5, 0.999):
        p = _Packing(lengths, counts, capacity)
        for config, amount in sorted(program.amounts.items(), key=lambda r: (-r[1], r[0])):
            # rounded down to nothing where room is left: best-fit fills it better
            if up > 0.1 or not _room(lengths, config, capacity):
                p.use(dict(config), math.floor(amount + up))
        plans.append(p.finish())
    if min(map(_sequences, plans)) > math.ceil(program.bound * (1 + GAP) - 1e-6):
        plans.append(_dive(lengths, counts, capacity, program))
    return min(plans, key=_sequences), program


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Configurations {length: copies} with whole multiplicities whose pieces
    are exactly the histogram's."""
    return planned(histogram, capacity)[0]


def places(configs: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """length -> rows (first rank, copies, first sequence, offset): the pieces
    of that length, in rank order, fill the configurations that hold it."""
    out, ranks, sequence = {}, {}, 0
    for config, m in configs:
        offset = 0
        for length in sorted(config, reverse=True):
            n = config[length]
            out.setdefault(length, []).append((ranks.get(length, 0), n, sequence, offset))
            ranks[length] = ranks.get(length, 0) + m * n
            offset += n * length
        sequence += m
    return {k: np.array(v, dtype=np.int64) for k, v in out.items()}


def packed(piece_rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``piece_rows`` (written; with a ``length``) plus sequence_id and offset."""
    histogram = {r.length: r.n for r in piece_rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    where = places(plan(histogram, capacity))
    cols = piece_rows.columns
    order = ["doc_id", "piece", "ids_crc32"]    # rows equal in all three share a part
    ranked = numbered(piece_rows.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(BUCKETS))),
                      "length", "_b", order, "_rank").select(*cols, "_rank")

    def run(batches):
        for pdf in batches:
            length, rank = pdf["length"].to_numpy(), pdf.pop("_rank").to_numpy()
            sequence, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
            for n in np.unique(length):
                own = np.nonzero(length == n)[0]
                rows = where[int(n)]
                at = rows[np.searchsorted(rows[:, 0], rank[own], side="right") - 1]
                k = rank[own] - at[:, 0]
                sequence[own] = at[:, 2] + k // at[:, 1]
                offset[own] = at[:, 3] + k % at[:, 1] * n
            yield pdf.assign(doc_id=pdf["doc_id"].astype("Int64"), sequence_id=sequence, offset=offset)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in piece_rows.schema)
    return ranked.mapInPandas(run, f"{schema}, sequence_id long, offset long")


def packed_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    return packed(written(pieces(docs.select("doc_id", "text"), tokenizer, capacity), "pieces"), capacity)
