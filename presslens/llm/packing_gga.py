"""Best-fit packing by a grouping genetic algorithm.

Pieces of at most a sequence's length are packed into as few sequences as possible. Pieces
that fill a sequence stand alone; the others are dealt to cells of bounded size by a hash of their row
number, and every cell is solved by a few islands, each a population of packings (a packing is
a partition of the cell's pieces into bins). A generation crosses two packings: whole
well-filled bins of one are injected into the other, bins there that hold an injected
piece are dissolved, and the displaced pieces go back by best fit, longest first. Between epochs every
island's elite migrates to the next island. Cells and islands are rows of a table, so they evolve
in parallel and a lost task is run again from the written epoch. At the end the bins of all
cells that are not full are dissolved, and their pieces, now far fewer, are dealt anew and solved as another level, as
long as that takes fewer bins.

All choices come from seeds made of cell, island and epoch: reruns over the same table of pieces agree.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.llm.common import small_batches, written
from presslens.llm.orc_tokens import END
from presslens.llm.tokens import definition, encoder

CELL_BITS = 24  # bins of a cell stay under 2^24
LEVEL_BITS = 57  # cells of a level under 2^33
LEVELS = 6  # each deals anew what the one before could not fill, as long as that saves sequences


def _cut(tokenizer, spaces: bool, capacity: int):
    def run(batches):
        enc = encoder(tokenizer.value, spaces)
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            texts = (text for _, part in enc.encode_rows(batch.column(1)) for text in part)
            for i, text in zip(ids, texts):
                data = text.as_py() + END
                for piece, a in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[a:a + 4 * capacity]
                    out.append((i, piece, a // 4, len(part) // 4, zlib.crc32(part)))
            cols = zip(*out) if out else [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def cut_pieces(docs: DataFrame, tokenizer: str, spaces: bool = False, capacity: int = 2048) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every text's ids and the end id 0, in runs of ``capacity``."""
    small_batches(docs.sparkSession)
    text = docs.sparkSession.sparkContext.broadcast(definition(tokenizer))
    return docs.select("doc_id", "text").mapInArrow(
        _cut(text, spaces, capacity), "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(sizes: np.ndarray, items: np.ndarray, bins: np.ndarray, room: list[int], capacity: int) -> None:
    """Puts ``items``, longest first, each into the bin with the least room that holds it (a new one where none does).

    ``bins`` gets each item's bin, ``room`` the room left; bits of one number tell which amounts of room there are.
    """
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for b, r in enumerate(room):
        if r > 0:
            by_room[r].append(b)
            mask |= 1 << r
    order = items[np.argsort(-sizes[items], kind="stable")]
    for i, s in zip(order.tolist(), sizes[order].tolist()):
        fits = mask >> s
        if fits:
            r = s + (fits & -fits).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                mask ^= 1 << r
        else:
            b, r = len(room), capacity
            room.append(capacity)
        bins[i] = b
        r -= s
        room[b] = r
        if r:
            by_room[r].append(b)
            mask |= 1 << r


def fill_of(sizes: np.ndarray, bins: np.ndarray) -> np.ndarray:
    return np.bincount(bins, sizes).astype(np.int64)


def fitness(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> float:
    """Fewer bins first, then the mean square of their fill: full bins beside emptier ones are easier to improve."""
    fill = fill_of(sizes, bins)
    return -len(fill) + float(np.mean((fill / capacity) ** 2))


def crossover(sizes: np.ndarray, into: np.ndarray, giver: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """``into`` with about a half of ``giver``'s well-filled bins, displaced items put back by best fit."""
    fill = fill_of(sizes, giver)
    well = fill >= np.median(fill)
    chosen = well & (rng.random(len(fill)) < 0.5)
    injected = chosen[giver]
    if not injected.any():
        return into.copy()
    broken = np.zeros(into.max() + 1, bool)  # bins that hold an injected item would hold it twice
    broken[into[injected]] = True
    emptiest = np.argsort(fill_of(sizes, into))[:max(1, len(broken) // 50)]
    broken[emptiest] = True  # the emptiest are dissolved too: only so can the number of bins fall
    displaced = broken[into] & ~injected
    stays = ~broken[into] & ~injected
    out = np.empty_like(into)
    new_giver = np.cumsum(chosen) - 1
    out[injected] = new_giver[giver[injected]]
    kept = ~broken
    new_into = np.cumsum(kept) - 1 + int(chosen.sum())
    out[stays] = new_into[into[stays]]
    room = np.concatenate([capacity - fill[chosen], capacity - fill_of(sizes, into)[kept]]).tolist()
    best_fit(sizes, np.flatnonzero(displaced), out, room, capacity)
    _, out = np.unique(out, return_inverse=True)  # bins that got empty go
    return out.astype(np.int64)


def start_packing(sizes: np.ndarray, capacity: int, rng: np.random.Generator, greedy: bool) -> np.ndarray:
    """Best fit of all items longest first, or after a random part of them is placed in random order."""
    bins, room = np.empty(len(sizes), np.int64), []
    if not greedy:
        early = rng.permutation(len(sizes))[:len(sizes) // 10]
        for i in np.array_split(early, max(1, len(early) // 8)):
            best_fit(sizes, i, bins, room, capacity)
        rest = np.setdiff1d(np.arange(len(sizes)), early)
    else:
        rest = np.arange(len(sizes))
    best_fit(sizes, rest, bins, room, capacity)
    return bins


def evolve(sizes: np.ndarray, population: list[np.ndarray], capacity: int, generations: int,
           rng: np.random.Generator) -> list[np.ndarray]:
    """Generations of crossover; a child takes the worst one's place when it is better. Best first."""
    least = -(-int(sizes.sum()) // capacity)
    scored = sorted(((fitness(sizes, p, capacity), -i, p) for i, p in enumerate(population)), reverse=True, key=lambda x: x[:2])
    for g in range(generations):
        if len(scored) < 2 or scored[0][2].max() + 1 <= least:
            break
        a, b = rng.choice(len(scored), 2, replace=False)
        child = crossover(sizes, scored[min(a, b)][2], scored[max(a, b)][2], capacity, rng)
        f = fitness(sizes, child, capacity)
        if f > scored[-1][0]:
            scored[-1] = (f, -len(population) - g, child)
            scored.sort(reverse=True, key=lambda x: x[:2])
    return [p for _, _, p in scored]


_ISLAND = "cell long, island int, uids binary, sizes binary, members int, population binary"


def _settle(capacity: int, members: int, generations: int, seed: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        cell, island = key
        pdf = pdf.sort_values("uid")
        sizes = pdf["length"].to_numpy(np.int64)
        rng = np.random.default_rng([seed, cell, island, 0])
        pop = [start_packing(sizes, capacity, rng, greedy=i == 0) for i in range(members)]
        pop = evolve(sizes, pop, capacity, generations, rng)
        return _island(cell, island, pdf["uid"].to_numpy("<i8").tobytes(), sizes, pop)
    return run


def _island(cell, island, uids: bytes, sizes: np.ndarray, pop: list[np.ndarray]) -> pd.DataFrame:
    return pd.DataFrame({"cell": [cell], "island": [island], "uids": [uids], "sizes": [sizes.astype("<i4").tobytes()],
                         "members": [len(pop)], "population": [np.stack(pop).astype("<i4").tobytes()]})


def _epoch(capacity: int, generations: int, seed: int, epoch: int):
    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                sizes = np.frombuffer(r.sizes, "<i4").astype(np.int64)
                pop = list(np.frombuffer(r.population, "<i4").reshape(r.members, -1).astype(np.int64))
                pop[-1] = np.frombuffer(r.elite, "<i4").astype(np.int64)  # the newcomer takes the worst one's place
                rng = np.random.default_rng([seed, r.cell, r.island, epoch])
                yield _island(r.cell, r.island, r.uids, sizes, evolve(sizes, pop, capacity, generations, rng))
    return run


def _elite(capacity: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = np.frombuffer(pdf["sizes"].iloc[0], "<i4").astype(np.int64)
        elites = [np.frombuffer(p, "<i4", len(sizes)).astype(np.int64) for p in pdf.sort_values("island")["population"]]
        bins = max(elites, key=lambda b: fitness(sizes, b, capacity))
        order = np.lexsort((np.arange(len(bins)), bins))
        first = np.concatenate(([True], bins[order][1:] != bins[order][:-1]))
        ends = np.cumsum(sizes[order])
        starts = ends - sizes[order]
        offset = starts - np.repeat(starts[first], np.diff(np.append(np.flatnonzero(first), len(order))))
        return pd.DataFrame({"uid": np.frombuffer(pdf["uids"].iloc[0], "<i8")[order], "length": sizes[order], "cell": key[0],
                             "bin": bins[order], "offset": offset, "fill": fill_of(sizes, bins)[bins[order]]})
    return run


def solve_cells(items: DataFrame, capacity: int, cell_items: int, islands: int, members: int, epochs: int,
                generations: int, seed: int) -> DataFrame:
    """(uid, length, cell, bin, offset, fill) of items (uid, length): every cell's best packing."""
    cells = -(-items.count() // cell_items) or 1
    dealt = items.select("uid", "length", F.pmod(F.xxhash64("uid", F.lit(seed)), F.lit(cells)).alias("cell"),
                         F.explode(F.array(*map(F.lit, range(islands)))).alias("island"))
    world = written(dealt.groupBy("cell", "island").applyInPandas(_settle(capacity, members, generations, seed), _ISLAND), "islands")
    for epoch in range(1, epochs if islands > 1 and members > 1 else 1):
        moving = world.select("cell", ((F.col("island") + 1) % islands).alias("island"),
                              F.expr("substring(population, 1, length(sizes))").alias("elite"))
        world = written(world.join(moving, ["cell", "island"]).mapInPandas(_epoch(capacity, generations, seed, epoch), _ISLAND), "islands")
    return written(world.groupBy("cell").applyInPandas(
        _elite(capacity), "uid long, length long, cell long, bin long, offset long, fill long"), "packed")


def pack(pieces: DataFrame, capacity: int = 2048, cell_items: int = 4096, islands: int = 2, members: int = 4,
         epochs: int = 2, generations: int = 8, seed: int = 42) -> DataFrame:
    """``pieces`` (length, any more) with sequence_id and offset.

    Pieces of equal length are as good as one another, so repeated rows need no care; an empty table gives no rows. Every
    length is from 1 to ``capacity``.
    """
    rows = written(pieces.select(F.struct("*").alias("piece"), F.monotonically_increasing_id().alias("uid"), "length"), "pieces")
    options = dict(capacity=capacity, cell_items=cell_items, islands=islands, members=members, epochs=epochs, generations=generations)
    placed = rows.where(F.col("length") >= capacity).select(
        "uid", F.lit(0).cast("long").alias("offset"), (F.col("uid") + F.lit(1 << 62)).alias("sequence_id"))
    left, bins = rows.where(F.col("length") < capacity).select("uid", "length"), None
    for level in range(LEVELS):
        solved = solve_cells(left, seed=seed + level, **options).withColumn(
            "sequence_id", F.shiftleft(F.lit(level).cast("long"), LEVEL_BITS) + F.shiftleft("cell", CELL_BITS) + F.col("bin"))
        spread = solved.select(F.countDistinct("cell").alias("cells"), F.countDistinct("sequence_id").alias("bins"),
                               F.countDistinct(F.when(F.col("fill") < capacity, F.col("sequence_id"))).alias("open")).first()
        if bins is not None and spread["bins"] >= bins:
            break  # the bins were better as they were
        full = solved.where(F.col("fill") >= capacity)
        last, left, bins = solved.where(F.col("fill") < capacity), solved.where(F.col("fill") < capacity).select("uid", "length"), spread["open"]
        placed = placed.union(full.select("uid", "offset", "sequence_id"))
        if spread["cells"] <= 1 or not bins:
            break
    placed = placed.union(last.select("uid", "offset", "sequence_id"))
    own = [F.col("piece").getField(c).alias(c) for c in pieces.columns if c not in ("offset", "sequence_id")]
    return rows.join(placed, "uid").select(*own, "offset", "sequence_id")
