"""Alternatives for every listing at once, without shuffling or sorting pairs.

The rules are those of :func:`staylens.operators.alternatives.alternative_listings`. Candidates
(the listings available on the date) are filed under the grid cells, about as large as the radius, that their radius
reaches; a listing looks into its own cell. The listings of a cell and room type are dealt over tiles of about ``TILE`` by
a hash of their ids, and each tile's candidates stream past it, ``BLOCKS * block_size`` at a time, in one task. There the
shared amenities of each listing and each candidate it can pay for are counted in bytes, one row of bytes for each of its
amenities that many candidates have and a list of places for each of the others. The listings are taken in windows that lie
close together, so that a byte also holds a class of distance of the candidate from the window, once by the least and
once by the greatest it can be. These bytes alone tell which few candidates can be among a listing's ``n`` best; only for
those the distance is computed. Where they don't tell (a window as wide as the radius, many at one place), distances in
single precision with a bound on their error do. All of a listing's candidates pass its task, so what leaves it are ``n``
candidates a listing (and what can't be told from them within rounding), in one row. Distances, and the radius and the
ranks where rounding could change them, are then decided by the same native expressions as for one listing, so the result
is exact. Every listing of a cell is still held against every candidate it can pay for: the time is quadratic in a dense
cell, some nanoseconds a pair; memory and disk are not.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.functions import amenity_list, haversine_km, money_b
from staylens.functions.columns import EARTH_RADIUS_KM
from staylens.operators.alternatives import available_on_date

#: Listings of a cell and room type in one tile, about.
TILE = 65536
#: Blocks of candidates that a tile meets at a time.
BLOCKS = 64
#: Tasks over the tiles for each shuffle partition.
TASKS_PER_PARTITION = 4
_CELL = ["cx", "cy", "room_type"]


def _degrees(max_km: float) -> float:
    """Degrees of latitude in the radius, with half a per cent of slack for rounding."""
    return max_km / (math.radians(1.0) * EARTH_RADIUS_KM) * 1.005


def _places(listings: DataFrame, *more: Column | str) -> DataFrame:
    return listings.select(
        "room_type",
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        *more,
    )


def _columns_of_grid(size: float) -> int:
    return math.ceil(360.0 / size)


def _own_cell(size: float) -> tuple[Column, Column]:
    cx = F.pmod(F.floor((F.col("longitude") + 180.0) / size), F.lit(_columns_of_grid(size)))
    return cx.alias("cx"), F.floor((F.col("latitude") + 90.0) / size).alias("cy")


def _reached_cells(size: float) -> Column:
    """The cells ``(cx, cy)`` that a radius around a candidate reaches."""
    # how far the radius reaches in longitude; everywhere near a pole
    reach = F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.radians(F.lit(min(size, 90.0)))) / F.cos(F.radians("latitude")))))
    reach = F.when(F.abs(F.col("latitude")) + size >= 90.0, F.lit(180.0)).otherwise(reach * 1.005)
    low, high = F.col("longitude") + 180.0 - reach, F.col("longitude") + 180.0 + reach
    # the last column of the grid may be narrower than the others: one more across the date line
    first = F.floor(low / size) - F.when(low < 0, 1).otherwise(0)
    last = F.floor(high / size) + F.when(high >= 360.0, 1).otherwise(0)
    columns = F.array_distinct(
        F.transform(F.sequence(first, last), lambda x: F.pmod(x, F.lit(_columns_of_grid(size))))
    )
    lines = F.sequence(F.floor((F.col("latitude") + 90.0) / size) - 1, F.floor((F.col("latitude") + 90.0) / size) + 1)
    cells = F.transform(columns, lambda x: F.transform(lines, lambda y: F.struct(x.alias("cx"), y.alias("cy"))))
    return F.flatten(cells)


def _tiles(listings: DataFrame, size: float) -> DataFrame:
    """``(cx, cy, room_type, tiles)`` of the cells that need several tiles: at most a row for each ``TILE`` listings."""
    known = _places(listings).where("latitude is not null and longitude is not null and room_type is not null")
    counts = known.select("room_type", *_own_cell(size)).groupBy(*_CELL).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > TILE).select(*_CELL, F.ceil(F.col("_n") / TILE).alias("tiles"))


def _dealt(listings: DataFrame, calendar: DataFrame, date, max_price_increase_pct: float, max_km: float) -> DataFrame:
    """A row for each listing id in its own cell and tile, and one for each candidate in all tiles of the cells it reaches
    (``member``). Of rows that repeat an id, the first in the order that the single-listing query uses is looked for;
    each can be a candidate. The rows are joined with the calendar and sorted by id once for both."""
    size = _degrees(max_km)
    rows = _places(
        listings.where(F.col("amenities").isNotNull()),
        "id",
        money_b("price").alias("price"),
        amenity_list("amenities").alias("amen"),
    )
    free = available_on_date(calendar, date).distinct().withColumn("_free", F.lit(True))
    rows = rows.join(free, rows.id == free.listing_id, "left").drop("listing_id")
    order = Window.partitionBy("id").orderBy("latitude", "longitude", "price", "room_type", "amen")
    rows = rows.withColumns({"_first": F.row_number().over(order) == 1, "_free": F.col("_free").isNotNull()})
    # rows that can be or have alternatives
    rows = rows.where("id is not null and price is not null and room_type is not null")
    rows = rows.where((F.abs("latitude") < F.lit(math.inf)) & (F.abs("longitude") < F.lit(math.inf)))
    kind = "array<struct<member:boolean,cx:bigint,cy:bigint>>"
    own = F.array(F.struct(F.lit(False).alias("member"), *_own_cell(size)))
    reached = F.transform(_reached_cells(size), lambda c: F.struct(F.lit(True).alias("member"), c["cx"].alias("cx"), c["cy"].alias("cy")))
    cells = F.when(F.col("_first") & F.col("_free"), F.concat(own.cast(kind), reached.cast(kind)))
    cells = cells.when(F.col("_first"), own.cast(kind)).otherwise(reached.cast(kind))
    # the outer forms of explode, because the others compute their arrays twice; none is empty
    rows = rows.where(F.col("_first") | F.col("_free")).withColumn("_cell", F.explode_outer(cells))
    cap = F.col("price") * (F.lit(1.0) + F.lit(float(max_price_increase_pct)) / F.lit(100.0))
    rows = rows.select(
        "_cell.member", "_cell.cx", "_cell.cy", "room_type", "id", "latitude", "longitude",
        F.when(F.col("_cell.member"), F.col("price")).otherwise(cap).alias("price"), "amen",
    )
    rows = rows.join(F.broadcast(_tiles(listings, size)), _CELL, "left")
    tiles = F.coalesce("tiles", F.lit(1).cast("long"))
    own_tile = F.array(F.pmod(F.xxhash64("id"), tiles))
    tile = F.when(F.col("member"), F.sequence(F.lit(0).cast("long"), tiles - 1)).otherwise(own_tile)
    return rows.withColumn("tile", F.explode_outer(tile)).drop("tiles")


def _best_of_tiles(max_km: float, n: int, hold: int) -> Callable:
    """The function over rows of :func:`_dealt`, sorted by tile and with the listings of a tile before its candidates, of which
    it holds ``hold`` at a time. It names nothing of this module, so that it is sent by value."""
    angle = max_km / EARTH_RADIUS_KM
    # squared chords; what lies within the slack of a limit is left to the native expressions
    limit = 4.0 * math.sin(angle / 2.0) ** 2 if angle < math.pi else 5.0
    slack = 1e-12 if angle < 1.5 else 1e-6
    kept_columns = ["id", "latitude", "longitude", "price"]

    def best(batches):
        import itertools

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def values(table, name):
            return table.column(name).to_numpy()

        def units(table):
            """Places as points of the unit sphere, a row for each axis."""
            lat, lon = np.radians(values(table, "latitude")), np.radians(values(table, "longitude"))
            return np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)])

        def tokens(table, vocabulary):
            """Row and code of each token that the vocabulary has."""
            codes = pc.index_in(pc.list_flatten(table.column("amen")), value_set=vocabulary)
            owner = np.repeat(np.arange(table.num_rows), pc.list_value_length(table.column("amen")).to_numpy())
            there = pc.is_valid(codes).to_numpy()
            return owner[there], codes.drop_null().to_numpy().astype(np.int64)

        def ends(lengths):
            return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)

        def spread(start, length):
            """The numbers from each start on, as many as its length, and whose they are."""
            whose = np.repeat(np.arange(len(start)), length)
            return np.repeat(start - ends(length)[:-1], length) + np.arange(len(whose)), whose

        def ranks_of(table):
            """Codes in the order of the ids, and codes of the places."""
            where = np.stack([values(table, "latitude"), values(table, "longitude")])
            return np.unique(values(table, "id"), return_inverse=True)[1], np.unique(where, axis=1, return_inverse=True)[1].ravel()

        def first_ids(row, common, code, place):
            """At one place and with as much in common the ids decide."""
            order = np.lexsort((code, -common, place, row))
            row, common, place = row[order], common[order], place[order]
            new = np.ones(len(order), bool)
            new[1:] = (np.diff(row) != 0) | (np.diff(place) != 0) | (np.diff(common) != 0)
            first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
            return np.sort(order[np.arange(len(order)) - first < n])

        def parted(table):
            """The listings in blocks that lie close together, by cap in each, and windows of a block's rows."""
            count, at = table.num_rows, np.arange(table.num_rows)
            many = max(1, round(math.sqrt(count / min(max(count // 16, 256), 1024))))
            block = np.empty(count, np.int64)
            block[np.argsort(values(table, "latitude"), kind="stable")] = at * many // count
            block[np.lexsort((values(table, "longitude"), block))] = at * many**2 // count
            order = np.lexsort((values(table, "price"), block))
            edges = [0, *(np.flatnonzero(np.diff(block[order])) + 1).tolist(), count]
            windows = [(x, min(x + 256, b)) for a, b in zip(edges, edges[1:]) for x in range(a, b, 256)]
            return table.take(pa.array(order)), windows

        def pieces():
            for batch in batches:
                table, count = pa.table(batch), batch.num_rows
                new = np.zeros(count, bool)
                for c in ("cx", "cy", "room_type", "tile"):
                    if count > 1:
                        new[1:] |= pc.not_equal(batch.column(c)[1:], batch.column(c)[:-1]).to_numpy(zero_copy_only=False)
                at = [0, *np.flatnonzero(new).tolist(), count] if count else [0]
                for a, b in zip(at, at[1:]):
                    yield tuple(batch.column(c)[a].as_py() for c in ("cx", "cy", "room_type", "tile")), table.slice(a, b - a)

        def meet(searches, windows, ours, members, least, kept, pool):
            """The listings with some of their candidates. ``least`` has each listing's n least keys so far; a key is
            the squared chord less 8 for each shared amenity. ``kept`` has row, key and amenities of each line of ``pool``."""
            members = members.take(pa.array(np.argsort(values(members, "price"), kind="stable")))
            count, held = searches.num_rows, members.num_rows
            cap, price, theirs = values(searches, "price"), values(members, "price"), units(members)
            # the candidates' tokens: a row of bytes for those of many candidates, the candidates of each other one
            vocabulary = pc.unique(pc.list_flatten(members.column("amen")))
            owner, code = tokens(members, vocabulary)
            # a byte holds the shared amenities times the number of classes of distance, and the class
            most = int(np.bincount(owner, minlength=1).max()) + 1
            kind = np.uint8 if most < 42 else np.uint16 if most < 8192 else np.uint32
            classes = 255 // most if most < 42 else 64 if most < 1000 else 7
            classes = min(classes, 16 if most < 42 else 64)
            pair, times = np.unique(code * held + owner, return_counts=True)
            code, owner = pair // held, pair % held
            length = np.bincount(code, minlength=len(vocabulary))
            dense = length * 64 > held
            line = np.where(dense, np.cumsum(dense) - 1, dense.sum())
            counts = np.zeros((dense.sum() + 1, held), kind)
            counts[line[code[dense[code]]], owner[dense[code]]] = times[dense[code]] * classes
            start, length = ends(length)[:-1], np.where(dense, 0, length)
            # the listings' tokens, each once
            row, mine = tokens(searches, vocabulary)
            pair = np.unique(row * (len(vocabulary) + 1) + mine)
            row, mine = pair // (len(vocabulary) + 1), pair % (len(vocabulary) + 1)
            held_by = np.bincount(row, minlength=count)
            mine_at = ends(held_by)
            # the candidates that have a listing's own id
            names = pc.unique(members.column("id"))
            named = pc.index_in(members.column("id"), value_set=names).to_numpy()
            by_name, name_at = np.argsort(named, kind="stable"), ends(np.bincount(named, minlength=len(names)))
            own = pc.fill_null(pc.index_in(searches.column("id"), value_set=names), -1).to_numpy()
            # distances in single precision, about the middle of the candidates, in a unit that keeps them below 4
            middle = theirs[:, np.isfinite(theirs[0])].mean(axis=1, keepdims=True) if np.isfinite(theirs[0]).any() else np.zeros((3, 1))
            near, far = ours - middle, theirs - middle
            unit = max(np.nanmax(np.square(x).sum(axis=0), initial=1e-24) for x in (near, far))
            near, far = near / np.sqrt(unit), far / np.sqrt(unit)
            one = lambda x: np.ones((1, x.shape[1]))
            left = np.concatenate([-2 * near, np.square(near).sum(axis=0, keepdims=True), one(near)]).astype(np.float32).T.copy()
            right = np.concatenate([far, one(far), np.square(far).sum(axis=0, keepdims=True)]).astype(np.float32)
            wrong = 2e-5 + 1e-6 * most
            ranks = []
            hits = [], [], [], []

            def judge(rows, row, col, common):
                """Row, column, key and amenities of the pairs within the radius, and each row's n least keys with them."""
                chord = np.zeros(len(row))
                for x, y in zip(ours, theirs):
                    chord += np.square(x[rows[row]] - y[col])
                inside = chord < limit + slack
                row, col, common, chord = row[inside], col[inside], common[inside], chord[inside]
                key = chord - 8.0 * common
                per = np.bincount(row, minlength=len(rows))
                wide = np.full((len(rows), n + int(per.max(initial=0))), np.inf)
                wide[:, :n] = least[rows]
                # what the radius may yet shut out sets no bar
                wide[row, n + np.arange(len(row)) - ends(per)[row]] = np.where(chord < limit - slack, key, np.inf)
                if wide.shape[1] > n:
                    wide = np.partition(wide, n - 1, axis=1)[:, :n]
                return row, col, key, common, wide

            def keep(rows, row, col, key, common, now):
                least[rows] = now
                good = key <= now[:, -1][row] + slack + 1e-14 * common
                row, col, key, common = rows[row[good]], col[good], key[good], common[good]
                if len(row) > 4 * n * len(rows):
                    if not ranks:
                        ranks.extend(ranks_of(members))
                    few = first_ids(row, common, ranks[0][col], ranks[1][col])
                    row, col, key, common = row[few], col[few], key[few], common[few]
                for part, x in zip(hits, (row, col, key, common)):
                    part.append(x)

            for a, b in windows:
                m = int(np.searchsorted(price, cap[b - 1], "right"))
                if not m:
                    continue
                rows = a + np.argsort(-held_by[a:b], kind="stable")
                # least and greatest distance of each candidate from the window's listings, and what is in reach
                lowest, highest = ours[:, a:b].min(axis=1)[:, None], ours[:, a:b].max(axis=1)[:, None]
                past, before = theirs[:, :m] - highest, lowest - theirs[:, :m]
                nearest = np.square(np.maximum(np.maximum(past, before), 0.0)).sum(axis=0) - 2 * slack
                farthest = np.square(np.maximum(np.abs(past), np.abs(before))).sum(axis=0) + 2 * slack
                sure, reached = (farthest < limit - slack).astype(kind), (nearest < limit + slack).astype(kind)
                # classes of distance, the greatest the nearest; the limits are where each is some share of the one before
                sample = np.sort(farthest[:: 1 + m // 1024])
                share = (min(n, m) / (2.0 * m)) ** (np.arange(classes - 2, 0, -1) / (classes - 2))
                limits = sample[(share * len(sample)).astype(np.int64)]
                class_of = lambda x, at=limits: (classes - 1 - np.searchsorted(at, x)).astype(kind)
                at_best, at_worst = class_of(nearest) * reached, class_of(farthest)
                padded = np.zeros((b - a, (m + 7) // 8 * 8), kind)
                found = padded[:, :m]
                for j in range(int(held_by[rows[0]])):
                    some = rows[: int((held_by[rows] > j).sum())]
                    word = mine[mine_at[some] + j]
                    if dense[word].any():
                        found[: len(some)] += counts[:, :m][line[word]]
                    at, whose = spread(start[word], length[word])
                    if len(at):
                        inside = owner[at] < m
                        at, whose = at[inside], whose[inside]
                        found[whose, owner[at]] += (times[at] * classes).astype(kind)
                worst = found + at_worst
                worst *= sure
                found += at_best
                found *= reached
                # what a listing can't pay for and what has its id
                for i, end in enumerate(np.searchsorted(price, cap[rows], "right").tolist()):
                    if end < m:
                        found[i, end:] = 0
                        worst[i, end:] = 0
                for i in np.flatnonzero(own[rows] >= 0):
                    same = by_name[name_at[own[rows[i]]] : name_at[own[rows[i]] + 1]]
                    found[i, same[same < m]] = 0
                    worst[i, same[same < m]] = 0
                # n groups of candidates have one that is surely as good or better
                width = max(1, min(64, m // (8 * n)))
                groups = m // width
                enough = np.zeros(b - a, np.int64)
                if groups >= n:
                    greatest = worst[:, : groups * width].reshape(b - a, width, groups).max(axis=1)
                    enough = np.partition(greatest, groups - n, axis=1)[:, groups - n].astype(np.int64)
                bar = least[rows, -1]
                known = np.isfinite(bar)
                shared = -np.floor(np.where(known, bar, 0.0) / 8.0)
                so_far = classes * shared.astype(np.int64) + class_of(np.where(known, bar, 0.0) + 8.0 * shared + 2 * slack)
                enough = np.maximum(enough, np.where(known, so_far, 0))
                told = enough > 0
                bar = np.where(told, np.minimum(enough, np.iinfo(kind).max), np.iinfo(kind).max).astype(kind)
                # few are as good: eight at a time are looked at
                eight = (padded >= bar[:, None]).view(np.uint64)
                some = np.flatnonzero(eight != 0)
                flat = np.flatnonzero(eight.ravel()[some].view(bool))
                flat = some[flat // 8] * 8 + flat % 8
                row = flat // padded.shape[1]
                told &= np.bincount(row, minlength=b - a) * 16 <= max(m, 1024)
                flat, row = flat[told[row]], row[told[row]]
                col = flat - row * padded.shape[1]
                row, col, key, common, now = judge(rows, row, col, (padded.ravel()[flat].astype(np.int64) - at_best[col]) // classes)
                told &= np.isfinite(now[:, -1])
                good = told[row]
                at = np.cumsum(told) - 1
                keep(rows[told], at[row[good]], col[good], key[good], common[good], now[told])
                # the others by their counts and their distances
                rest = np.flatnonzero(~told)
                for c in range(0, len(rest), 64):
                    these = rest[c : c + 64]
                    some, there = rows[these], found[these] > 0
                    has = ((found[these] - at_best) // kind(classes) + kind(1)) * there
                    apart = left[some] @ right[:, :m]
                    keys = has * np.float32(-8.0)
                    keys += apart
                    keys[~(apart < np.float32(limit / unit + wrong)) | ~there] = np.inf
                    bar, known = least[some, -1], np.isfinite(least[some, -1])
                    shared = -np.floor(np.where(known, bar, 0.0) / 8.0)
                    bar = np.where(known, (np.where(known, bar, 0.0) + 8.0 * shared) / unit - 8.0 * (shared + 1.0), np.inf)
                    if groups >= n:
                        inner = np.where(apart < np.float32(limit / unit - wrong), keys, np.float32(np.inf))
                        smallest = inner[:, : groups * width].reshape(len(some), width, groups).min(axis=1)
                        bar = np.minimum(bar, np.partition(smallest, n - 1, axis=1)[:, n - 1])
                    flat = np.flatnonzero((keys <= (bar + 2 * wrong).astype(np.float32)[:, None]) & (keys < np.inf))
                    row = flat // m
                    keep(some, *judge(some, row, flat - row * m, has.ravel()[flat].astype(np.int64) - 1))
            row, col, key, common = (np.concatenate(part) if part else np.empty(0, np.int64) for part in hits)
            new = members.select(kept_columns).take(pa.array(col))
            pool = new if pool is None else pa.concat_tables([pool, new])
            kept = tuple(np.concatenate(x) for x in zip(kept, (row, key, common)))
            good = np.flatnonzero(kept[1] <= least[:, -1][kept[0]] + slack + 1e-14 * kept[2])
            if len(good) < len(kept[0]):
                kept, pool = tuple(x[good] for x in kept), pool.take(pa.array(good))
            if len(kept[0]) > 2 * n * count:
                few = first_ids(kept[0], kept[2], *ranks_of(pool))
                kept, pool = tuple(x[few] for x in kept), pool.take(pa.array(few))
            return kept, pool

        def rows_of(searches, kept, pool):
            order = np.lexsort((kept[1], kept[0]))
            row, key, common = (x[order] for x in kept)
            per = np.bincount(row, minlength=searches.num_rows)
            # what rounding could change: the radius, or the order of two
            doubt = 2 * slack + 4e-14 * common
            unsure = key + 8.0 * common >= limit - doubt
            unsure[1:] |= (row[1:] == row[:-1]) & (key[1:] - key[:-1] <= doubt[1:])
            certain = (per <= n) & (np.bincount(row[unsure], minlength=len(per)) == 0)
            pool = pool.take(pa.array(order)).combine_chunks()
            columns = [pool.column(c).combine_chunks() for c in kept_columns] + [pa.array(common)]
            columns = [x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in columns]
            found = pa.ListArray.from_arrays(
                pa.array(ends(per).astype(np.int32)), pa.StructArray.from_arrays(columns, [*kept_columns, "common_amenities"])
            )
            some = np.flatnonzero(per)
            for c in range(0, len(some), 4096):
                at = pa.array(some[c : c + 4096])
                out = [searches.column(x).take(at).combine_chunks() for x in kept_columns[:3]]
                out = [x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in out]
                out += [pa.array(certain[some[c : c + 4096]]), found.take(at)]
                yield pa.RecordBatch.from_arrays(out, ["of", "lat", "lon", "certain", "found"])

        for _, parts in itertools.groupby(pieces(), key=lambda x: x[0]):
            searches, members, waiting, least = [], [], 0, None
            kept, pool = (np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)), None
            for part in itertools.chain((x for _, x in parts), [None]):
                if part is not None:
                    of_these = int(np.searchsorted(values(part, "member"), True))
                    searches.extend([part.slice(0, of_these)] if of_these else [])
                    members.extend([part.slice(of_these)] if of_these < part.num_rows else [])
                    waiting += part.num_rows - of_these
                if not searches:
                    members, waiting = [], 0
                elif waiting >= hold or (part is None and waiting):
                    if least is None:
                        searches = [pa.concat_tables(searches)]
                        searches[0], windows = parted(searches[0])
                        ours, least = units(searches[0]), np.full((searches[0].num_rows, n), np.inf)
                    kept, pool = meet(searches[0], windows, ours, pa.concat_tables(members), least, kept, pool)
                    members, waiting = [], 0
            if len(kept[0]):
                yield from rows_of(searches[0], kept, pool)

    return best


def _found(
    listings: DataFrame, calendar: DataFrame, date, max_price_increase_pct: float, max_km: float, n: int, block_size: int
) -> DataFrame:
    """``(of, lat, lon, certain, found)``: of each listing id, the candidates that may be among its ``n`` best; where that is
    ``certain``, they are, in the order of their ranks."""
    rows = _dealt(listings, calendar, date, max_price_increase_pct, max_km)
    group = [*_CELL, "tile"]
    type_of = {f.name: f.dataType.simpleString() for f in rows.schema.fields}["id"]
    # a number of partitions that is stated isn't merged by AQE: a task's time follows the pairs, not the bytes
    tasks = TASKS_PER_PARTITION * int(listings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(tasks, *group).sortWithinPartitions(*group, "member")
    candidate = f"struct<id:{type_of},latitude:double,longitude:double,price:double,common_amenities:bigint>"
    return rows.mapInArrow(
        _best_of_tiles(float(max_km), n, BLOCKS * block_size),
        f"of {type_of}, lat double, lon double, certain boolean, found array<{candidate}>",
    )


def _by_distance(found: Column, max_km: float, n: int) -> Column:
    """The best ``n`` of the candidates by their exact distances; ``less`` is the number of shared amenities below zero, so that
    the order of the structs is that of the ranks."""
    judged = F.transform(
        found,
        lambda c: F.struct(
            (-c["common_amenities"]).alias("less"),
            haversine_km(F.col("lat"), F.col("lon"), c["latitude"], c["longitude"]).alias("distance"),
            c["id"].alias("id"),
            c["price"].alias("price"),
            c.alias("_c"),
        ),
    )
    within = F.filter(judged, lambda c: c["distance"] < F.lit(float(max_km)))
    return F.transform(F.slice(F.sort_array(within), 1, n), lambda c: c["_c"])


def opened_pairs(
    listings: DataFrame,
    calendar: DataFrame,
    date,
    max_price_increase_pct: float,
    max_km: float,
    n: int,
    block_size: int = 256,
) -> DataFrame:
    """``(of, id, common_amenities, distance, price)``: all pairs that may be among the best ``n`` of a
    listing. What the final ranking reads: about ``n`` for each listing."""
    rows = _found(listings, calendar, date, max_price_increase_pct, max_km, n, block_size)
    rows = rows.select("of", "lat", "lon", F.explode("found").alias("_c")).select("of", "lat", "lon", "_c.*")
    rows = rows.withColumn("distance", haversine_km("lat", "lon", "latitude", "longitude"))
    return rows.where(F.col("distance") < F.lit(float(max_km))).select("of", "id", "common_amenities", "distance", "price")


def alternatives_all_pairs(
    listings: DataFrame,
    calendar: DataFrame,
    date,
    max_price_increase_pct: float,
    max_km: float,
    n: int,
    block_size: int = 256,
) -> DataFrame:
    """``(id, rank, listing_id, common_amenities, distance, price)``: the top ``n`` alternatives of every
    listing on ``date``, ranked by common amenities desc, then distance, then id.

    Listings without an id, amenities, coordinates or a readable price have no alternatives and are none. The listing
    itself is never among its alternatives; a listing id that repeats is ranked once."""
    rows = _found(listings, calendar, date, max_price_increase_pct, max_km, n, block_size)
    best = F.when(F.col("certain"), F.col("found")).otherwise(_by_distance(F.col("found"), max_km, n))
    rows = rows.select("of", "lat", "lon", F.posexplode_outer(best).alias("pos", "_c")).where(F.col("pos").isNotNull())
    return rows.select(
        F.col("of").alias("id"),
        (F.col("pos") + 1).cast("bigint").alias("rank"),
        F.col("_c.id").alias("listing_id"),
        F.col("_c.common_amenities").alias("common_amenities"),
        haversine_km("lat", "lon", "_c.latitude", "_c.longitude").alias("distance"),
        F.col("_c.price").alias("price"),
    )
