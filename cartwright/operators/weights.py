"""Sums over all pairs of a signature and a rule, block by block of rules.

A rule holds in some contexts and a signature matches some, so what a signature's rules weigh is a product of
two matrices: signatures by contexts, contexts by rules. Rows for each (signature, context, rule), of which there
are far more than results, are never made. A task holds the matches and a block of rules; products are
taken in portions of a fixed size.

The functions that run in tasks travel with the job; workers need numpy and pyarrow.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Numbers in a matrix, entries of rules in a block, and the whole numbers that doubles hold exactly.
PORTION = 1 << 21
BLOCK_ENTRIES = 1 << 16
EXACT = float(1 << 53)

SUMS = "signature long, antecedent_id long, consequent long, units long, level_mask int"
PLACES = "signature long, antecedent_id long, consequent long, places binary"


def _dealt(entries: DataFrame, matches: DataFrame):
    """Entries of rules and the matches, grouped by blocks of rules; a rule lies in one block."""
    spark = entries.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(least, -(-entries.count() // BLOCK_ENTRIES))
    block = F.pmod(F.xxhash64("antecedent_id", "consequent"), F.lit(blocks)).alias("block")
    every = F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")).alias("block")
    return entries.select(block, "*").groupBy("block").cogroup(matches.select(every, "*").groupBy("block"))


def sums(entries: DataFrame, matches: DataFrame, unit: float) -> DataFrame:
    """``SUMS``: for each signature and rule that share a context, the summed ``weighted * match_ratio``, each
    in whole ``1 / unit``, and the bits of the contexts' levels.

    ``entries`` is (context, antecedent_id, consequent, weighted, bit), ``matches`` (signature, context, match_ratio).
    """
    entries = entries.select("context", "antecedent_id", "consequent", "weighted", "bit")

    def of_block(rules: pa.Table, held: pa.Table) -> pa.Table:
        parts = list(_summed(rules, held, unit))
        return pa.concat_tables(parts) if parts else _table((np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.int32),), SUMS)

    return _dealt(entries, matches.select("signature", "context", "match_ratio")).applyInArrow(of_block, SUMS)


def places(entries: DataFrame, matches: DataFrame) -> DataFrame:
    """``PLACES``: for each signature and rule that share a context, one bit for each context of the signature,
    set where the rule holds.

    ``entries`` is (context, antecedent_id, consequent), ``matches`` (signature, context, place), places from 0.
    """
    entries = entries.select("context", "antecedent_id", "consequent")

    def of_block(rules: pa.Table, held: pa.Table) -> pa.Table:
        parts = list(_placed(rules, held))
        if parts:
            return pa.concat_tables(parts)
        empty = pa.array([], pa.int64())
        return pa.table([empty, empty, empty, pa.array([], pa.binary())], _names(PLACES))

    return _dealt(entries, matches.select("signature", "context", "place")).applyInArrow(of_block, PLACES)


def bit_counts(rows: DataFrame, key: str, group: str, cell: str) -> DataFrame:
    """(key, group, place, n): how many of the ``places`` of a key have each bit set. All are whole numbers; a
    missing key is a key of its own. Counts are added up in tasks first: those of a cell's keys are held as long as
    rows of the cell follow each other."""
    columns = ["_group", "_cell", "_key", "_none"]
    numbers = [F.col(group).cast("long"), F.col(cell).cast("long"), F.coalesce(F.col(key).cast("long"), F.lit(0)), F.col(key).isNull().cast("long")]
    dealt = rows.select(*[n.alias(c) for n, c in zip(numbers, columns)], "places")
    found = dealt.mapInArrow(_bits_counted, ", ".join(f"{c} long" for c in columns) + ", place int, n long")
    named = F.when(F.col("_none") == 0, F.col("_key")).cast(rows.schema[key].dataType).alias(key)
    found = found.groupBy("_group", "_key", "_none", "place").agg(F.sum("n").alias("n"))
    return found.select(named, F.col("_group").cast(rows.schema[group].dataType).alias(group), "place", "n")


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _table(columns, schema: str) -> pa.Table:
    return pa.table([pa.array(c) for c in columns], _names(schema))


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _rules(rules: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(antecedents, consequents, rule of each entry) of the block's distinct rules."""
    ants, of_ant = np.unique(_numbers(rules, "antecedent_id"), return_inverse=True)
    cons, of_cons = np.unique(_numbers(rules, "consequent"), return_inverse=True)
    pairs, of_entry = np.unique(of_ant.ravel() * len(cons) + of_cons.ravel(), return_inverse=True)
    return ants[pairs // len(cons)], cons[pairs % len(cons)], of_entry.ravel()


def _portions(n: int, width: int) -> Iterator[tuple[int, int]]:
    step = max(1, PORTION // max(width, 1))
    return ((a, min(a + step, n)) for a in range(0, n, step))


def _slices(rules: pa.Table, held: pa.Table):
    """Portions of rules by portions of signatures:
    (entries, their contexts, their rules, antecedents, consequents), (matches, their signatures, their contexts, signatures)."""
    contexts, of_match = np.unique(_numbers(held, "context"), return_inverse=True)
    at = np.minimum(np.searchsorted(contexts, _numbers(rules, "context")), max(len(contexts) - 1, 0))
    known = np.flatnonzero(contexts[at] == _numbers(rules, "context")) if len(contexts) else np.zeros(0, np.int64)
    if not len(known):
        return
    ants, cons, rule = _rules(rules.take(pa.array(known)))
    at = at[known]
    by_rule = np.argsort(rule, kind="stable")
    signatures, of_signature = np.unique(_numbers(held, "signature"), return_inverse=True)
    of_match, of_signature = of_match.ravel(), of_signature.ravel()
    by_signature = np.argsort(of_signature, kind="stable")
    for c, d in _portions(len(signatures), len(contexts)):
        some = by_signature[slice(*np.searchsorted(of_signature, (c, d), sorter=by_signature))]
        here = some, of_signature[some] - c, of_match[some], signatures[c:d]
        for a, b in _portions(len(ants), max(len(contexts), d - c)):
            mine = by_rule[slice(*np.searchsorted(rule, (a, b), sorter=by_rule))]
            yield (known[mine], at[mine], rule[mine] - a, ants[a:b], cons[a:b]), here


def _dense(rows: np.ndarray, columns: np.ndarray, values, shape: tuple[int, int], kind=np.float64) -> np.ndarray:
    """A matrix of summed values."""
    flat = np.bincount(rows * shape[1] + columns, values, shape[0] * shape[1])
    return flat.reshape(shape).astype(kind, copy=False)


def _within(chosen: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(the distinct numbers below n, where each number lies among them)."""
    which = np.unique(chosen)
    where = np.full(n, -1)
    where[which] = np.arange(len(which))
    return which, where


def _summed(rules: pa.Table, held: pa.Table, unit: float) -> Iterator[pa.Table]:
    if not len(rules) or not len(held):
        return
    weight, bit = _numbers(rules, "weighted"), _numbers(rules, "bit")
    ratio = _numbers(held, "match_ratio")
    for (entry, at, rule, ants, cons), (match, sig, of_match, signatures) in _slices(rules, held):
        n, shape = int(max(at.max(), of_match.max() if len(of_match) else 0)) + 1, (len(signatures), len(ants))
        units, exact = np.zeros(shape), True
        for r in np.unique(ratio[match]).tolist():
            mine = ratio[match] == r
            which, where = _within(of_match[mine], n)
            fit = where[at] >= 0
            x = weight[entry[fit]] * r * unit
            low = np.floor(np.abs(x))
            x = np.copysign(low + (np.abs(x) - low >= 0.5), x)
            values = _dense(where[at[fit]], rule[fit], x, (len(which), len(ants)))
            bound = _dense(where[at[fit]], rule[fit], np.abs(x), (len(which), len(ants))).sum(axis=0).max(initial=0.0)
            matched = _dense(sig[mine], where[of_match[mine]], None, (len(signatures), len(which)))
            if bound * max(1.0, matched.max(initial=0.0)) * 8 > EXACT:
                # Too large to add up as doubles: whole numbers are slower, but exact.
                units, exact = units.astype(np.int64), False
                whole = np.zeros(values.shape, np.int64)
                np.add.at(whole, (where[at[fit]], rule[fit]), x.astype(np.int64))
                units += matched.astype(np.int64) @ whole
            else:
                units += (matched @ values).astype(units.dtype)
        mask, present = np.zeros(shape, np.int32), np.zeros(shape, bool)
        for b in np.unique(bit[entry]).tolist():
            fit = bit[entry] == b
            which, where = _within(at[fit], n)
            mine = where[of_match] >= 0
            holds = _dense(where[at[fit]], rule[fit], None, (len(which), len(ants)), np.float32) > 0
            matched = _dense(sig[mine], where[of_match[mine]], None, (len(signatures), len(which)), np.float32) > 0
            both = (matched.astype(np.float32) @ holds.astype(np.float32)) > 0
            present |= both
            mask[both] |= b
        s, p = np.nonzero(present)
        yield _table((signatures[s], ants[p], cons[p], units[s, p].astype(np.int64), mask[s, p]), SUMS)


def _placed(rules: pa.Table, held: pa.Table) -> Iterator[pa.Table]:
    if not len(rules) or not len(held):
        return
    place = _numbers(held, "place")
    for (_, at, rule, ants, cons), (match, sig, of_match, signatures) in _slices(rules, held):
        n = int(max(at.max(), of_match.max() if len(of_match) else 0)) + 1
        holds = _dense(at, rule, None, (n, len(ants)), np.float32) > 0
        order = np.argsort(sig, kind="stable")
        cuts = np.searchsorted(sig[order], np.arange(len(signatures) + 1))
        for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            mine = order[a:b]
            if not len(mine):
                continue
            # All contexts of the signature are here, so its bits are equally long in every block.
            bits = np.zeros((len(ants), int(place[match[mine]].max()) + 1), bool)
            bits[:, place[match[mine]]] = holds[of_match[mine]].T
            some = np.flatnonzero(bits.any(axis=1))
            packed = np.packbits(bits[some], axis=1, bitorder="little")
            offsets = np.arange(len(some) + 1, dtype=np.int32) * packed.shape[1]
            body = pa.BinaryArray.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(offsets), pa.py_buffer(packed.tobytes())])
            yield pa.table([pa.array(np.full(len(some), signatures[i])), pa.array(ants[some]), pa.array(cons[some]), body], _names(PLACES))


def _bits_counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    columns = ["_group", "_cell", "_key", "_none"]
    cell, rows, counts = None, {}, np.zeros((0, 0), np.int64)

    def out() -> pa.RecordBatch:
        i, place = np.nonzero(counts[: len(rows)])
        key = np.array(list(rows), np.int64).reshape(-1, 2)[i]
        found = [np.full(len(i), cell[0]), np.full(len(i), cell[1]), key[:, 0], key[:, 1], place.astype(np.int32), counts[i, place]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in found], [*columns, "place", "n"])

    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in columns])
        cuts = np.flatnonzero((keys[:2, 1:] != keys[:2, :-1]).any(axis=0)) + 1
        body = batch.column("places")
        at = np.frombuffer(body.buffers()[1], np.int32, len(body) + 1, body.offset * 4)
        data, lengths = np.frombuffer(body.buffers()[2], np.uint8), np.diff(at)
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if a == b:
                continue
            if cell != tuple(keys[:2, a].tolist()):
                if rows:
                    yield out()
                cell, rows, counts = tuple(keys[:2, a].tolist()), {}, np.zeros((0, 0), np.int64)
            order = a + np.lexsort(keys[2:, a:b])
            mine = keys[2:, order]
            starts = np.concatenate([[0], np.flatnonzero((mine[:, 1:] != mine[:, :-1]).any(axis=0)) + 1])
            width = int(lengths[a:b].max())
            # The bits of a group are equally long.
            packed = data[at[:-1][order, None] + np.arange(width)]
            bits = np.unpackbits(packed, axis=1, bitorder="little")
            found = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
            where = [rows.setdefault(k, len(rows)) for k in zip(*mine[:, starts].tolist())]
            if len(rows) > len(counts) or counts.shape[1] != width * 8:
                grown = np.zeros((max(len(rows), 2 * len(counts)), width * 8), np.int64)
                grown[: len(counts), : counts.shape[1]] = counts
                counts = grown
            counts[where] += found
    if rows:
        yield out()
