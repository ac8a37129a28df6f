"""Sample sizes for the cells of several distributions at once, so that a sample keeps every one of them.

The cells are the combinations of values that occur, so their number depends on the labels and not on the rows; they are fitted on the driver, which takes
`MOST_CELLS` of them at most. Real-valued quotas come from iterative proportional fitting to the wanted margins. They are rounded one dimension after the other: the table of the
dimensions so far against the next one is rounded to whole numbers next to its real ones, by moving fractions around cycles and along paths of cells that
have any, which leaves every row and column sum at one of its two neighbouring whole numbers.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.operators.ordering import sample_per_stratum
from vitrine.workspace import stage

MOST_CELLS = 200_000
_SMALL = 1e-9


def fitted(cells: dict[tuple, float], margins: list[dict], rounds: int = 500, near: float = 1e-12) -> dict[tuple, float]:
    """The cells scaled by rows and columns of every dimension in turn until all sums are those of `margins` (one dict of value and sum a dimension)."""
    cells = dict(cells)
    for _ in range(rounds):
        worst = 0.0
        for d, wanted in enumerate(margins):
            sums: dict = defaultdict(float)
            for key, x in cells.items():
                sums[key[d]] += x
            scale = {v: wanted[v] / s if s else 0.0 for v, s in sums.items()}
            worst = max([worst, *(abs(k - 1) for k in scale.values() if k)])
            cells = {key: x * scale[key[d]] for key, x in cells.items()}
        if worst < near:
            break
    return cells


def rounded(cells: dict[tuple, float]) -> dict[tuple, int]:
    """A table of (row, column) rounded to neighbouring whole numbers, with all row and column sums and the total at neighbouring whole numbers, too.

    A further row and column take what rows and columns lack to the next whole number, so that every sum is whole and only cycles are left.
    """
    whole_table, rest = dict(cells), object()
    for side in (0, 1):
        sums: dict = defaultdict(float)
        for key, x in cells.items():
            sums[key[side]] += x
        for v, x in sums.items():
            whole_table[(v, rest) if side == 0 else (rest, v)] = max(0.0, math.ceil(x - _SMALL) - x)
    total = sum(cells.values())
    whole_table[rest, rest] = max(0.0, total - math.floor(total + _SMALL))
    found = _rounded(whole_table)
    return {k: found[k] for k in cells}


def _rounded(cells: dict[tuple, float]) -> dict[tuple, int]:
    keys = sorted(cells, key=repr)
    whole = [math.floor(cells[k] + _SMALL) for k in keys]
    part = [max(0.0, cells[k] - w) for k, w in zip(keys, whole)]
    lines: dict[tuple, set[int]] = defaultdict(set)  # cells with a fraction, by row and by column

    def ends(i: int) -> tuple[tuple, tuple]:
        return (0, keys[i][0]), (1, keys[i][1])

    for i, x in enumerate(part):
        if x > _SMALL:
            for line in ends(i):
                lines[line].add(i)
    open_ = {line for line, some in lines.items() if some}
    singles = {line for line in open_ if len(lines[line]) == 1}
    while open_:
        way = _way(min(singles or open_, key=repr), lines, ends)
        plus, minus = way[::2], way[1::2]
        up = min([1 - part[i] for i in plus] + [part[i] for i in minus])
        down = min([part[i] for i in plus] + [1 - part[i] for i in minus])
        step = up if up <= down else -down
        for sign, some in ((1, plus), (-1, minus)):
            for i in some:
                part[i] += sign * step
                if not _SMALL < part[i] < 1 - _SMALL:
                    whole[i] += part[i] > 0.5
                    for line in ends(i):
                        lines[line].discard(i)
        for line in {line for i in way for line in ends(i)}:
            singles.discard(line)
            if not lines[line]:
                open_.discard(line)
            elif len(lines[line]) == 1:
                singles.add(line)
    return dict(zip(keys, whole))


def _way(start: tuple, lines: dict[tuple, set[int]], ends) -> list[int]:
    """Cells with fractions, each sharing a row or column with the next: a cycle, or a path between two lines with one such cell each."""
    way: list[int] = []
    met, line = {start: 0}, start
    while True:
        options = lines[line].difference(way[-1:])
        if not options:
            return way
        cell = min(options)
        a, b = ends(cell)
        line = b if line == a else a
        way.append(cell)
        if line in met:
            return way[met[line] :]
        met[line] = len(way)


def cell_quotas(counts: dict[tuple, int], margins: list[dict]) -> dict[tuple, int]:
    """Whole quotas for all cells; the sum over each value of each dimension is next to its margin, a cell's next to its fitted share."""
    cells = fitted({k: float(n) for k, n in counts.items()}, margins)
    done: dict[tuple, int] = {}
    for d in range(1, len(margins)):
        # rows are the cells of the dimensions before, whole after the first round; columns are the values of this one
        table = defaultdict(float)
        for k, x in cells.items():
            table[k[:d], k[d]] += x
        if d > 1:
            total = sum(done.values())
            scale = total / (sum(margins[d].values()) or 1.0)
            table = fitted(table, [{k: float(n) for k, n in done.items()}, {v: x * scale for v, x in margins[d].items()}])
        done = {(*row, column): n for (row, column), n in rounded(table).items()}
    return _mended(done, counts, margins)


def _mended(quotas: dict[tuple, int], counts: dict[tuple, int], margins: list[dict], steps: int = 2000) -> dict[tuple, int]:
    """Rows moved from one cell to another, added or taken away, as long as that brings sums that are a row or more away from their margin nearer."""
    quotas, sums = dict(quotas), margin_counts(quotas, len(margins))
    keys = sorted(quotas, key=repr)

    def excess(d: int, v, change: int) -> float:
        return max(0.0, abs(sums[d][v] + change - margins[d][v]) - (1 - 1e-6))

    def gain(changes: dict) -> float:
        return sum(excess(d, v, 0) - excess(d, v, n) for (d, v), n in changes.items())

    def of(key: tuple, n: int, before: dict | None = None) -> dict:
        changes = dict(before or {})
        for d, v in enumerate(key):
            changes[d, v] = changes.get((d, v), 0) + n
        return changes

    for _ in range(steps):
        wrong = [(d, v) for d in range(len(margins)) for v in margins[d] if excess(d, v, 0) > 0]
        if not wrong:
            break
        d, v = max(wrong, key=lambda w: (excess(*w, 0), repr(w)))
        sign = 1 if sums[d][v] < margins[d][v] else -1
        room = lambda k, n: quotas[k] < counts[k] if n > 0 else quotas[k] > 0
        best = (1e-9, None, None)
        for a in keys:
            if a[d] != v or not room(a, sign):
                continue
            alone = of(a, sign)
            best = max(best, (gain(alone), a, None), key=lambda x: x[0])
            for b in keys:
                if b[d] != v and room(b, -sign):
                    best = max(best, (gain(of(b, -sign, alone)), a, b), key=lambda x: x[0])
        if best[1] is None:
            break
        for key, n in ((best[1], sign), (best[2], -sign)):
            if key is not None:
                quotas[key] += n
                for e, w in enumerate(key):
                    sums[e][w] += n
    return quotas


def margin_counts(cells: dict[tuple, int], dimensions: int) -> list[dict]:
    out: list[dict] = [defaultdict(int) for _ in range(dimensions)]
    for key, n in cells.items():
        for d, value in enumerate(key):
            out[d][value] += n
    return out


def balanced_sample(df: DataFrame, dimensions: list[str], key: str, fraction: float, wanted: list[dict] | None = None) -> DataFrame:
    """Rows whose distribution over every dimension is that of all rows, each value at its share within one row, chosen by the md5 order of a unique key.

    wanted: other margins, one dict of value and rows a dimension. A null value is a value like any other.
    """
    if len(dimensions) < 2:
        raise ValueError("one distribution needs no fitting; use a stratified sample")
    named = df.withColumn("_cell", F.to_json(F.struct(*dimensions), {"ignoreNullFields": "false"}))
    cells = named.groupBy("_cell", *dimensions).agg(F.count(F.lit(1)).alias("n")).limit(MOST_CELLS + 1).collect()
    if len(cells) > MOST_CELLS:
        raise ValueError(f"more than {MOST_CELLS} cells; take fewer or coarser dimensions")
    counts = {tuple(r[d] for d in dimensions): r["n"] for r in cells}
    margins = wanted or [{v: n * fraction for v, n in m.items()} for m in margin_counts(counts, len(dimensions))]
    quotas = cell_quotas(counts, margins)
    table = df.sparkSession.createDataFrame([(r["_cell"], min(r["n"], quotas[tuple(r[d] for d in dimensions)])) for r in cells] or [], "_of string, _wanted long")
    return sample_per_stratum(named, "_cell", F.col(key), quotas=stage(table, "wanted")).drop("_cell")
