"""DuckDB SQL oracles for the registered queries.

Each string runs on the driver's parquet tables (pre-registered as views) and
restates, independently of the Spark code, both the adapter mapping and the
query semantics. Doubles are rounded exactly as in ``staylens.plans.catalog``.
Polygon edges are produced here from a template edge list joined to the
suppliers, not by exploding nested coordinates, and containment is a brute
force even-odd test over all edges; so the Spark plans are checked against a
different formulation, not against themselves.
"""

from __future__ import annotations

from staylens.plans import catalog as C
from staylens.sources import testdata as TD

FINE, MONEY = C.FINE, C.MONEY


def _template_edges() -> str:
    rows = []
    for shape, parts in enumerate(TD.SHAPES):
        for part, rings in enumerate(parts):
            for ring, pts in enumerate(rings):
                cl = TD.closed(pts)
                for i in range(len(cl) - 1):
                    (a, b), (c, d) = cl[i], cl[i + 1]
                    rows.append(f"({shape}, {part}, {ring}, {i}, {a}, {b}, {c}, {d})")
    return ",\n    ".join(rows)


def _scaled(mult, mod, base, span) -> str:
    return (
        f"{base}::DOUBLE + CAST((o_orderkey * {mult}) % {mod} AS DOUBLE) / {float(mod)}::DOUBLE * {span}::DOUBLE"
    )


TOKENS = (
    "string_split(trim(regexp_replace(regexp_replace(lower(translate({c}, '\u0130\u212a', 'ik')), '[^0-9a-z''\\-&]', ' ', 'g'), ' +', ' ', 'g')), ' ')"
)
AMENITY_LIST = "string_split(regexp_replace(lower({c}), '[^0-9a-z,''/ \\-]', '', 'g'), ',')"
MONEY_A = "TRY_CAST(replace(replace({c}, '$', ''), ',', '') AS DOUBLE)"
MONEY_B = "TRY_CAST(regexp_replace({c}, '[^0-9.]', '', 'g') AS DOUBLE)"
ASCII_UPPER = "translate({c}, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')"
NIGHTS = "(coalesce(reviews_per_month, 0.0::DOUBLE) / 0.7::DOUBLE * 3.0::DOUBLE * 12.0::DOUBLE)"


def haversine(lat1, lon1, lat2, lon2) -> str:
    return (
        f"(2.0::DOUBLE * asin(sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2.0::DOUBLE), 2.0::DOUBLE)"
        f" + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin((radians({lon2}) - radians({lon1})) / 2.0::DOUBLE), 2.0::DOUBLE))) * 6371.0::DOUBLE)"
    )


# Adapter CTEs: name -> (dependencies, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "listings": (
        (),
        f"""SELECT o_orderkey AS id, CASE WHEN o_orderkey % {TD.Q_HOST_NULL} <> 0 THEN o_custkey END AS host_id,
           'host ' || CAST(o_custkey AS VARCHAR) AS host_name,
           'listing ' || CAST(o_orderkey AS VARCHAR) AS name,
           CASE WHEN o_orderkey % {TD.Q_CITY_NEW_YORK} = 0 THEN 'New York'
                WHEN o_orderkey % {TD.Q_CITY_LOWER} = 0 THEN lower(o_orderpriority)
                WHEN o_orderkey % {TD.Q_CITY_NULL} = 0 THEN NULL ELSE o_orderpriority END AS city,
           o_orderstatus AS room_type,
           CASE WHEN o_orderkey % {TD.Q_PRICE_NULL} = 0 THEN NULL
                WHEN o_orderkey % {TD.Q_PRICE_WORDS} = 0 THEN 'call us'
                WHEN o_orderkey % {TD.Q_PRICE_USD} = 0 THEN 'USD ' || format('{{:,.2f}}', o_totalprice)
                ELSE '$' || format('{{:,.2f}}', o_totalprice) END AS price,
           CASE WHEN o_orderkey % {TD.Q_LATITUDE_NULL} <> 0
                THEN {_scaled(TD.LAT_MULT, TD.LAT_MOD, TD.LAT_BASE, TD.LAT_SPAN)} END AS latitude,
           {_scaled(TD.LON_MULT, TD.LON_MOD, TD.LON_BASE, TD.LON_SPAN)} AS longitude,
           CAST(80 + (o_orderkey * 31) % 21 AS VARCHAR) AS review_scores_rating
    FROM orders""",
    ),
    "per_order": (
        (),
        f"""SELECT ok, reviews_per_month,
           CASE WHEN ok % {TD.Q_AMENITIES_NONE} = 0 THEN '{{}}'
                WHEN ok % {TD.Q_AMENITIES_QUOTED} = 0 THEN '{{"' || array_to_string(names, '","') || '"}}'
                ELSE '{{' || array_to_string(names, ',') || '}}' END AS amenities
    FROM (SELECT l_orderkey AS ok, CAST(count(*) AS DOUBLE) / 12.0::DOUBLE AS reviews_per_month,
                 list_sort(coalesce(list(DISTINCT p_name) FILTER (WHERE p_name IS NOT NULL), [])) AS names
          FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
          GROUP BY l_orderkey)""",
    ),
    "per_host": (
        (),
        "SELECT o_custkey AS hk, CAST(count(*) AS DOUBLE) AS host_listings_count FROM orders GROUP BY o_custkey",
    ),
    "listings_full": (
        ("listings", "per_order", "per_host"),
        """SELECT l.*, h.host_listings_count, p.reviews_per_month, p.amenities
    FROM listings l LEFT JOIN per_host h ON l.host_id = h.hk LEFT JOIN per_order p ON l.id = p.ok""",
    ),
    "calendar": (
        (),
        """SELECT l_orderkey AS listing_id, CAST(l_shipdate AS DATE) AS date,
           CASE WHEN l_linestatus = 'F' THEN 'f' ELSE 't' END AS available
    FROM lineitem""",
    ),
    "reviews": ((), "SELECT l_orderkey AS listing_id, l_suppkey AS reviewer_id FROM lineitem"),
    "descriptions": (
        (),
        f"""SELECT CASE WHEN doc_id % {TD.Q_ID_REPEATED} = 0 AND doc_id > 0 THEN doc_id - 1 ELSE doc_id END AS id,
           CASE WHEN doc_id % {TD.Q_TEXT_BLANK} = 0 THEN ' ! '
                WHEN doc_id % {TD.Q_TEXT_NULL} = 0 THEN NULL
                WHEN doc_id % {TD.Q_TEXT_CAPITALS} = 0 THEN '\u0130N \u212aO ' || text ELSE text END AS description,
           CASE WHEN doc_id % {TD.Q_TEXT_BLANK} = 0 THEN 'wordless'
                WHEN doc_id % {TD.Q_NEIGHBOURHOOD_NULL} = 0 THEN NULL ELSE source END AS neighbourhood
    FROM documents""",
    ),
    # -- polygons ---------------------------------------------------------
    "features": (
        (),
        f"""SELECT s_suppkey AS pid, s_name AS neighbourhood,
           'nation ' || CAST(s_nationkey AS VARCHAR) AS neighbourhood_group,
           CAST((s_suppkey % {TD.GRID_COLUMNS}) * {TD.CELL} AS DOUBLE) AS ox,
           CAST((s_suppkey // {TD.GRID_COLUMNS}) * {TD.CELL} AS DOUBLE) AS oy,
           s_suppkey % {len(TD.SHAPES)} AS shape
    FROM supplier""",
    ),
    "tmpl": (
        (),
        f"""SELECT * FROM (VALUES
    {_template_edges()}
    ) v(shape, part, ring, i, dx1, dy1, dx2, dy2)""",
    ),
    "edges": (
        ("features", "tmpl"),
        """SELECT f.pid, f.neighbourhood, f.neighbourhood_group, t.part, t.ring, t.i,
           f.ox + t.dx1 AS x1, f.oy + t.dy1 AS y1, f.ox + t.dx2 AS x2, f.oy + t.dy2 AS y2
    FROM features f JOIN tmpl t ON f.shape = t.shape""",
    ),
    "points": (
        (),
        f"""SELECT o_orderkey AS id, o_orderpriority AS city,
           CASE WHEN o_orderkey % {TD.Q_POINT_NULL} <> 0
                THEN CAST((o_orderkey * {TD.POINT_X_MULT}) % {TD.POINT_X_MOD} AS DOUBLE) END AS x,
           CAST((o_orderkey // {TD.ORDERS_PER_BAND}) * {TD.CELL} + (o_orderkey * {TD.POINT_Y_MULT}) % {TD.POINT_Y_MOD}
                AS DOUBLE) AS y
    FROM orders""",
    ),
    "pip": (
        ("points", "edges"),
        """SELECT id, pid, neighbourhood,
           sum(CASE WHEN ((y1 > y) <> (y2 > y)) AND (CASE WHEN y2 > y1 THEN t > 0 ELSE t < 0 END)
                    THEN 1 ELSE 0 END) AS crossings,
           bool_or(t = 0 AND x >= least(x1, x2) AND x <= greatest(x1, x2)) AS on_edge
    FROM (SELECT p.id, p.x, p.y, e.pid, e.neighbourhood, e.x1, e.y1, e.x2, e.y2,
                 (e.x2 - e.x1) * (p.y - e.y1) - (p.x - e.x1) * (e.y2 - e.y1) AS t
          FROM points p JOIN edges e ON p.y >= least(e.y1, e.y2) AND p.y <= greatest(e.y1, e.y2))
    GROUP BY id, pid, neighbourhood""",
    ),
    "edges_first": (("edges",), "SELECT * FROM edges WHERE part = 0 AND ring = 0"),
    "pip_first": (
        ("points", "edges_first"),
        """SELECT id, pid, neighbourhood,
           sum(CASE WHEN ((y1 > y) <> (y2 > y)) AND (CASE WHEN y2 > y1 THEN t > 0 ELSE t < 0 END)
                    THEN 1 ELSE 0 END) AS crossings,
           bool_or(t = 0 AND x >= least(x1, x2) AND x <= greatest(x1, x2)) AS on_edge
    FROM (SELECT p.id, p.x, p.y, e.pid, e.neighbourhood, e.x1, e.y1, e.x2, e.y2,
                 (e.x2 - e.x1) * (p.y - e.y1) - (p.x - e.x1) * (e.y2 - e.y1) AS t
          FROM points p JOIN edges_first e ON p.y >= least(e.y1, e.y2) AND p.y <= greatest(e.y1, e.y2))
    GROUP BY id, pid, neighbourhood""",
    ),
    "assigned_first": (
        ("points", "pip_first", "features"),
        """SELECT p.id, p.city, h.pid, f.neighbourhood
    FROM points p
    LEFT JOIN (SELECT id, min(pid) AS pid FROM pip_first WHERE crossings % 2 = 1 AND NOT on_edge GROUP BY id) h
           ON p.id = h.id
    LEFT JOIN features f ON h.pid = f.pid""",
    ),
    "assigned": (
        ("points", "pip", "features"),
        """SELECT p.id, p.city, h.pid, f.neighbourhood
    FROM points p
    LEFT JOIN (SELECT id, min(pid) AS pid FROM pip WHERE crossings % 2 = 1 AND NOT on_edge GROUP BY id) h
           ON p.id = h.id
    LEFT JOIN features f ON h.pid = f.pid""",
    ),
    "ntest": (
        ("points",),
        f"""SELECT CASE WHEN p.id % {TD.Q_LABEL_ID_NULL} <> 0 THEN p.id END AS id, s.s_name AS neighbourhood, p.city
    FROM (SELECT id, city,
                 CASE WHEN floor(x / {TD.CELL}) < {TD.GRID_COLUMNS}
                      THEN floor(y / {TD.CELL}) * {TD.GRID_COLUMNS} + floor(x / {TD.CELL}) END AS owner
          FROM points WHERE id % {TD.Q_LABEL_MISSING} <> 0) p
    LEFT JOIN supplier s ON p.owner = s.s_suppkey""",
    ),
    "mine_only": (
        ("assigned", "ntest"),
        """SELECT id, neighbourhood, city FROM assigned
    EXCEPT SELECT id, neighbourhood, city FROM ntest""",
    ),
    "test_only": (
        ("assigned", "ntest"),
        """SELECT id, neighbourhood, city FROM ntest
    EXCEPT SELECT id, neighbourhood, city FROM assigned""",
    ),
    "disagree": (
        ("mine_only", "test_only"),
        """SELECT m.id, m.neighbourhood AS my_neighbourhood, t.neighbourhood AS test_neighbourhood
    FROM mine_only m JOIN test_only t ON m.id = t.id""",
    ),
    # -- terms ------------------------------------------------------------
    "toks": (
        ("descriptions",),
        f"""SELECT id, neighbourhood, unnest({TOKENS.format(c='description')}) AS term
    FROM descriptions WHERE description IS NOT NULL""",
    ),
    "counts_l": (("toks",), "SELECT id, term, count(*) AS n FROM toks GROUP BY id, term"),
    "counts_n_raw": (("toks",), "SELECT neighbourhood, term, count(*) AS n FROM toks GROUP BY neighbourhood, term"),
    "counts_n": (
        ("counts_n_raw",),
        """SELECT neighbourhood, term, n FROM counts_n_raw WHERE term <> ''
    UNION ALL
    SELECT neighbourhood, '' AS term, 1 AS n FROM counts_n_raw c
    WHERE term = '' AND NOT EXISTS (SELECT 1 FROM counts_n_raw w
                                    WHERE w.term <> '' AND w.neighbourhood IS NOT DISTINCT FROM c.neighbourhood)""",
    ),
    "idf_l": (
        ("counts_l", "descriptions"),
        """SELECT term, CAST(count(*) AS BIGINT) AS df,
           (SELECT CAST(count(*) AS DOUBLE) FROM descriptions WHERE description IS NOT NULL)
               / CAST(count(*) AS DOUBLE) AS idf
    FROM counts_l GROUP BY term""",
    ),
    "idf_n": (
        ("counts_n", "descriptions"),
        """SELECT term, CAST(count(*) AS BIGINT) AS df,
           (SELECT CAST(count(DISTINCT neighbourhood) + max(CASE WHEN neighbourhood IS NULL THEN 1 ELSE 0 END) AS DOUBLE)
              FROM descriptions WHERE description IS NOT NULL) / CAST(count(*) AS DOUBLE) AS idf
    FROM counts_n GROUP BY term""",
    ),
    "tf_l": (
        ("counts_l",),
        """SELECT id, term, n, CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY id) AS DOUBLE) AS tf
    FROM counts_l""",
    ),
    "tf_n": (
        ("counts_n",),
        """SELECT neighbourhood, term, n,
           CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY neighbourhood) AS DOUBLE) AS tf
    FROM counts_n""",
    ),
    # -- alternatives -------------------------------------------------------
    "amen_listings": (
        ("listings", "per_order"),
        f"""SELECT l.id, l.name, l.room_type, l.latitude, l.longitude, l.host_name, l.review_scores_rating,
           {MONEY_B.format(c='l.price')} AS price,
           {AMENITY_LIST.format(c='p.amenities')} AS amen
    FROM listings l JOIN per_order p ON l.id = p.ok
    WHERE p.amenities IS NOT NULL""",
    ),
    "chosen": (
        ("amen_listings",),
        f"""SELECT id AS c_id, latitude AS c_latitude, longitude AS c_longitude, price AS c_price,
           room_type AS c_room_type, amen AS c_amenities
    FROM amen_listings WHERE id = {C.CHOSEN_LISTING}
    ORDER BY c_latitude, c_longitude, c_price LIMIT 1""",
    ),
    "alts": (
        ("amen_listings", "chosen", "calendar"),
        f"""SELECT a.id AS listing_id, a.name, a.latitude, a.longitude, a.host_name, a.review_scores_rating, a.price,
           CAST(len(list_filter(a.amen, lambda x: list_contains(c.c_amenities, x))) AS BIGINT) AS common_amenities,
           {haversine('c.c_latitude', 'c.c_longitude', 'a.latitude', 'a.longitude')} AS distance
    FROM amen_listings a JOIN chosen c ON a.room_type = c.c_room_type
    WHERE a.id IN (SELECT listing_id FROM calendar WHERE available = 't' AND date = DATE '{C.AVAILABLE_DATE}')
      AND a.price <= c.c_price * (1.0::DOUBLE + {C.MAX_PRICE_INCREASE_PCT}::DOUBLE / 100.0::DOUBLE)""",
    ),
    "alts_top": (
        ("alts",),
        f"""SELECT * FROM alts WHERE distance < {C.MAX_KM}::DOUBLE AND listing_id <> {C.CHOSEN_LISTING}
    ORDER BY common_amenities DESC, distance ASC, listing_id ASC LIMIT {C.N_ALTERNATIVES}""",
    ),
    "alts_top_self": (
        ("alts",),
        f"""SELECT * FROM alts WHERE distance < {C.MAX_KM}::DOUBLE
    ORDER BY common_amenities DESC, distance ASC, listing_id ASC LIMIT {C.N_ALTERNATIVES + 1}""",
    ),
}


def with_ctes(select: str, *names: str) -> str:
    """``WITH`` clause holding ``names`` and their dependencies, then ``select``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in CTES[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return select
    body = ",\n".join(f"{n} AS (\n    {CTES[n][1]}\n)" for n in order)
    return f"WITH {body}\n{select}"


def _profile_sql() -> str:
    cols = [
        "id", "host_id", "host_name", "name", "city", "room_type", "price", "latitude", "longitude",
        "review_scores_rating", "host_listings_count", "reviews_per_month", "amenities",
    ]
    parts = [
        f"SELECT '{c}' AS column_name, CAST(count(DISTINCT {ASCII_UPPER.format(c=f'CAST({c} AS VARCHAR)')}) AS BIGINT)"
        f" AS distinct_count FROM listings_full"
        for c in cols
    ]
    return with_ctes("\nUNION ALL\n".join(parts), "listings_full")


def _top_terms_one(mode: str, value) -> str:
    if mode == "listing":
        tf = f"SELECT term, tf FROM tf_l WHERE id = {value}"
        idf, ctes = "idf_l", ("tf_l", "idf_l")
    else:
        tf = f"SELECT term, tf FROM tf_n WHERE neighbourhood = '{value}'"
        idf, ctes = "idf_n", ("tf_n", "idf_n")
    return with_ctes(
        f"""SELECT term, round(weight, {FINE}) AS weight FROM (
    SELECT t.term, t.tf * i.idf AS weight FROM ({tf}) t JOIN {idf} i ON t.term = i.term
    ORDER BY weight DESC, term ASC LIMIT {C.TOP_TERMS})""",
        *ctes,
    )


def _top_terms_all(mode: str) -> str:
    key, tf, idf = ("id", "tf_l", "idf_l") if mode == "listing" else ("neighbourhood", "tf_n", "idf_n")
    return with_ctes(
        f"""SELECT {key}, rank, term, round(weight, {FINE}) AS weight FROM (
    SELECT {key}, term, weight,
           CAST(row_number() OVER (PARTITION BY {key} ORDER BY weight DESC, term ASC) AS BIGINT) AS rank
    FROM (SELECT t.{key}, t.term, t.tf * i.idf AS weight FROM {tf} t JOIN {idf} i ON t.term = i.term))
    WHERE rank <= {C.TOP_TERMS_ALL}""",
        tf,
        idf,
    )


def _alternatives(wide: bool, include_self: bool = False) -> str:
    cols = "listing_id, name, common_amenities, round(distance, 6) AS distance, round(price, 6) AS price"
    if wide:
        cols += ", round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, host_name, review_scores_rating"
    name = "alts_top_self" if include_self else "alts_top"
    return with_ctes(f"SELECT {cols} FROM {name}", name)


def _alternatives_all() -> str:
    return with_ctes(
        f"""SELECT id, rank, listing_id, common_amenities, round(distance, 6) AS distance, round(price, 6) AS price FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY common_amenities DESC, distance, listing_id) AS rank FROM (
        SELECT c.id, a.id AS listing_id, a.price,
               CAST(len(list_filter(a.amen, lambda x: list_contains(c.amen, x))) AS BIGINT) AS common_amenities,
               {haversine('c.latitude', 'c.longitude', 'a.latitude', 'a.longitude')} AS distance
        FROM amen_listings c JOIN amen_listings a ON a.room_type = c.room_type AND a.id <> c.id
        WHERE a.id IN (SELECT listing_id FROM calendar WHERE available = 't' AND date = DATE '{C.AVAILABLE_DATE}')
          AND a.price <= c.price * (1.0::DOUBLE + {C.MAX_PRICE_INCREASE_PCT}::DOUBLE / 100.0::DOUBLE))
    WHERE distance < {C.MAX_KM}::DOUBLE) WHERE rank <= {C.N_ALTERNATIVES}""",
        "amen_listings",
        "calendar",
    )


def _income() -> str:
    return f"""SELECT city, host_id, sum({MONEY_A.format(c='price')} * CAST(booked_nights AS DOUBLE)) AS income
    FROM ({_booked()}) GROUP BY city, host_id"""


def _booked() -> str:
    return """SELECT l.city, l.host_id, l.id, l.price,
           CAST(sum(CASE WHEN c.available = 'f' THEN 1 ELSE 0 END) AS BIGINT) AS booked_nights
    FROM listings l JOIN calendar c ON l.id = c.listing_id
    GROUP BY l.city, l.host_id, l.id, l.price"""


def _amenities(where: str) -> str:
    return with_ctes(
        f"""SELECT city, neighbourhood, string_agg(amenity, ',' ORDER BY amenity) AS amenities FROM (
    SELECT DISTINCT a.city, coalesce(a.neighbourhood, '') AS neighbourhood,
           unnest(string_split(replace(replace(replace(p.amenities, '{{', ''), '}}', ''), '"', ''), ',')) AS amenity
    FROM listings l JOIN per_order p ON l.id = p.ok JOIN assigned a ON l.id = a.id
    WHERE p.amenities IS NOT NULL {where})
    GROUP BY city, neighbourhood""",
        "listings",
        "per_order",
        "assigned",
    )


ORACLE: dict[str, str] = {
    # -- profile ----------------------------------------------------------
    "profile_distinct_ci": _profile_sql(),
    "profile_distinct_approx": f"SELECT *, true AS within_bound FROM ({_profile_sql()})",
    "distinct_cities": with_ctes("SELECT DISTINCT city FROM listings", "listings"),
    "distinct_states_normalised": with_ctes(
        f"""SELECT DISTINCT CASE WHEN {ASCII_UPPER.format(c='city')} = 'NEW YORK' THEN 'NY'
                        ELSE {ASCII_UPPER.format(c='city')} END AS value
    FROM listings WHERE city IS NOT NULL""",
        "listings",
    ),
    # -- pricing ----------------------------------------------------------
    "avg_price_by_city": with_ctes(
        f"SELECT city, round(avg({MONEY_A.format(c='price')}), {FINE}) AS avg_price FROM listings GROUP BY city",
        "listings",
    ),
    "avg_price_one_city": with_ctes(
        f"""SELECT '{C.ONE_CITY}' AS city, round(avg({MONEY_A.format(c='price')}), {FINE}) AS avg_price,
           count(*) AS n_listings
    FROM listings WHERE city = '{C.ONE_CITY}'""",
        "listings",
    ),
    "avg_price_by_city_room": with_ctes(
        f"""SELECT city, room_type, round(avg({MONEY_A.format(c='price')}), {FINE}) AS avg_price
    FROM listings GROUP BY city, room_type""",
        "listings",
    ),
    "avg_reviews_by_city": with_ctes(
        f"""SELECT city, round(avg(coalesce(reviews_per_month, 0.0::DOUBLE)), {FINE}) AS avg_reviews_per_month
    FROM listings_full GROUP BY city""",
        "listings_full",
    ),
    "avg_nights_per_year_by_city": with_ctes(
        f"SELECT city, round(avg({NIGHTS}), {FINE}) AS avg_nights_per_year FROM listings_full GROUP BY city",
        "listings_full",
    ),
    "yearly_spend_by_city": with_ctes(
        f"""SELECT city, round(sum({NIGHTS} * {MONEY_A.format(c='price')}), {MONEY}) AS yearly_spend
    FROM listings_full GROUP BY city""",
        "listings_full",
    ),
    # -- hosts ------------------------------------------------------------
    "listings_per_host": with_ctes(
        f"""SELECT n_listings, n_hosts, round(CAST(n_listings AS DOUBLE) / CAST(n_hosts AS DOUBLE), {FINE})
           AS listings_per_host
    FROM (SELECT CAST(count(DISTINCT id) + max(CASE WHEN id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_listings,
                 CAST(count(DISTINCT host_id) + max(CASE WHEN host_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_hosts
          FROM listings)""",
        "listings",
    ),
    "multi_listing_ratio_rows": with_ctes(
        f"""SELECT multi_listing_rows, host_pairs,
           round(CAST(multi_listing_rows AS DOUBLE) / CAST(host_pairs AS DOUBLE), {FINE}) AS ratio
    FROM (SELECT CAST(count(*) FILTER (WHERE coalesce(host_listings_count, 0.0) >= 2) AS BIGINT) AS multi_listing_rows,
                 CAST(count(DISTINCT row(host_id, host_listings_count)) AS BIGINT) AS host_pairs
          FROM listings_full)""",
        "listings_full",
    ),
    "multi_listing_host_share": with_ctes(
        f"""SELECT n_hosts, multi_listing_hosts,
           round(CAST(multi_listing_hosts AS DOUBLE) / CAST(n_hosts AS DOUBLE), {FINE}) AS share
    FROM (SELECT CAST(count(*) AS BIGINT) AS n_hosts, CAST(count(*) FILTER (WHERE multi) AS BIGINT) AS multi_listing_hosts
          FROM (SELECT host_id, max(coalesce(host_listings_count, 0.0)) >= 2 AS multi
                FROM listings_full GROUP BY host_id))""",
        "listings_full",
    ),
    "booked_nights_by_listing": with_ctes(_booked(), "listings", "calendar"),
    "host_income_by_city": with_ctes(
        f"SELECT city, host_id, round(income, {MONEY}) AS income FROM ({_income()})", "listings", "calendar"
    ),
    "top_hosts_by_city": with_ctes(
        f"""SELECT city, rank, host_id, round(income, {MONEY}) AS income FROM (
    SELECT city, host_id, income,
           CAST(row_number() OVER (PARTITION BY city ORDER BY income DESC, host_id ASC) AS BIGINT) AS rank
    FROM ({_income()})) WHERE rank <= 3""",
        "listings",
        "calendar",
    ),
    "top_hosts_by_city_lists": with_ctes(
        f"""SELECT city, string_agg(CAST(host_id AS VARCHAR), ',' ORDER BY rank) AS top_hosts FROM (
    SELECT city, host_id, row_number() OVER (PARTITION BY city ORDER BY income DESC, host_id ASC) AS rank
    FROM ({_income()})) WHERE rank <= 3 GROUP BY city""",
        "listings",
        "calendar",
    ),
    # -- guests -----------------------------------------------------------
    "reviews_by_city_guest": with_ctes(
        """SELECT l.city, r.reviewer_id, CAST(count(*) AS BIGINT) AS n_reviews
    FROM reviews r JOIN listings l ON r.listing_id = l.id GROUP BY l.city, r.reviewer_id""",
        "reviews",
        "listings",
    ),
    "top_guests_by_city": with_ctes(
        """SELECT city, max(CASE WHEN rank = 1 THEN reviewer_id END) AS guest_1,
           max(CASE WHEN rank = 2 THEN reviewer_id END) AS guest_2,
           max(CASE WHEN rank = 3 THEN reviewer_id END) AS guest_3
    FROM (SELECT city, reviewer_id,
                 row_number() OVER (PARTITION BY city ORDER BY n DESC, reviewer_id ASC) AS rank
          FROM (SELECT l.city, r.reviewer_id, count(*) AS n
                FROM reviews r JOIN listings l ON r.listing_id = l.id GROUP BY l.city, r.reviewer_id))
    WHERE rank <= 3 GROUP BY city""",
        "reviews",
        "listings",
    ),
    "spend_by_guest_listing": with_ctes(
        f"""SELECT r.reviewer_id, r.listing_id, round(sum({MONEY_A.format(c='l.price')} * 3.0::DOUBLE), {MONEY}) AS spend
    FROM reviews r JOIN listings l ON r.listing_id = l.id GROUP BY r.reviewer_id, r.listing_id""",
        "reviews",
        "listings",
    ),
    "spend_by_guest": with_ctes(
        f"""SELECT r.reviewer_id, round(sum({MONEY_A.format(c='l.price')} * 3.0::DOUBLE), {MONEY}) AS spend
    FROM reviews r JOIN listings l ON r.listing_id = l.id GROUP BY r.reviewer_id""",
        "reviews",
        "listings",
    ),
    "biggest_spender": with_ctes(
        f"""SELECT reviewer_id, round(spend, {MONEY}) AS spend FROM (
    SELECT r.reviewer_id, sum({MONEY_A.format(c='l.price')} * 3.0::DOUBLE) AS spend
    FROM reviews r JOIN listings l ON r.listing_id = l.id GROUP BY r.reviewer_id
    ORDER BY spend DESC, reviewer_id ASC LIMIT 1)""",
        "reviews",
        "listings",
    ),
    # -- spatial ----------------------------------------------------------
    "polygon_edges": with_ctes(
        "SELECT pid, neighbourhood, neighbourhood_group, part, ring, i, x1, y1, x2, y2 FROM edges", "edges"
    ),
    "polygon_bbox": with_ctes(
        """SELECT pid, neighbourhood, min(least(x1, x2)) AS min_x, min(least(y1, y2)) AS min_y,
           max(greatest(x1, x2)) AS max_x, max(greatest(y1, y2)) AS max_y, CAST(count(*) AS BIGINT) AS n_edges
    FROM edges WHERE ring = 0 GROUP BY pid, neighbourhood""",
        "edges",
    ),
    "assign_neighbourhood": with_ctes("SELECT id, city, pid, neighbourhood FROM assigned", "assigned"),
    "assign_neighbourhood_first_ring": with_ctes(
        "SELECT id, city, pid, neighbourhood FROM assigned_first", "assigned_first"
    ),
    "neighbourhood_disagreements": with_ctes("SELECT * FROM disagree", "disagree"),
    "neighbourhood_agreement_pct": with_ctes(
        f"""SELECT n_listings, n_disagreements, n_unlabelled,
           round(CAST(n_listings - n_disagreements AS DOUBLE) / CAST(n_listings AS DOUBLE) * 100.0::DOUBLE, {FINE})
               AS agreement_pct
    FROM (SELECT CAST(count(*) AS BIGINT) AS n_listings FROM assigned),
         (SELECT CAST(count(*) AS BIGINT) AS n_disagreements FROM disagree),
         (SELECT CAST(count(*) AS BIGINT) AS n_unlabelled FROM assigned a
          WHERE NOT EXISTS (SELECT 1 FROM ntest t WHERE t.id = a.id))""",
        "assigned",
        "disagree",
        "ntest",
    ),
    "polygon_edges_geojson": with_ctes(
        "SELECT pid, neighbourhood, neighbourhood_group, part, ring, i, x1, y1, x2, y2 FROM edges", "edges"
    ),
    "amenities_by_neighbourhood": _amenities(""),
    "amenities_one_city": _amenities(f"AND a.city = '{C.ONE_CITY}'"),
    "listing_price_points": with_ctes(
        "SELECT latitude AS lat, longitude AS lon, price, name FROM listings", "listings"
    ),
    # -- terms ------------------------------------------------------------
    "term_counts": with_ctes("SELECT id, term, CAST(n AS BIGINT) AS n FROM counts_l", "counts_l"),
    "idf_by_listing": with_ctes(f"SELECT term, round(idf, {FINE}) AS idf FROM idf_l", "idf_l"),
    "idf_by_neighbourhood": with_ctes(f"SELECT term, round(idf, {FINE}) AS idf FROM idf_n", "idf_n"),
    "idf_without_neighbourhood": with_ctes(
        f"""SELECT term, round((SELECT CAST(count(DISTINCT neighbourhood) + max(CASE WHEN neighbourhood IS NULL THEN 1 ELSE 0 END)
                                   AS DOUBLE)
                       FROM descriptions
                       WHERE description IS NOT NULL AND neighbourhood IS DISTINCT FROM '{C.TFIDF_NEIGHBOURHOOD}')
                      / CAST(count(*) AS DOUBLE), {FINE}) AS idf
    FROM counts_n WHERE neighbourhood IS DISTINCT FROM '{C.TFIDF_NEIGHBOURHOOD}' GROUP BY term""",
        "counts_n",
        "descriptions",
    ),
    "tf_one_listing": with_ctes(
        f"SELECT term, round(tf, {FINE}) AS tf FROM tf_l WHERE id = {C.TFIDF_LISTING}", "tf_l"
    ),
    "tfidf_top_terms_listing": _top_terms_one("listing", C.TFIDF_LISTING),
    "tfidf_top_terms_neighbourhood": _top_terms_one("neighbourhood", C.TFIDF_NEIGHBOURHOOD),
    "tfidf_top_terms_all": _top_terms_all("listing"),
    "tfidf_top_terms_all_neighbourhoods": _top_terms_all("neighbourhood"),
    "listing_corpus": with_ctes(
        """SELECT d.id, d.description, m.source AS neighbourhood
    FROM descriptions d JOIN documents m ON d.id = m.doc_id WHERE d.description IS NOT NULL""",
        "descriptions",
    ),
    # -- alternatives -----------------------------------------------------
    "listing_profile": with_ctes(
        f"""SELECT c_id AS id, round(c_latitude, {FINE}) AS latitude, round(c_longitude, {FINE}) AS longitude,
           round(c_price, {FINE}) AS price, c_room_type AS room_type, array_to_string(c_amenities, '|') AS amenities
    FROM chosen""",
        "chosen",
    ),
    "available_on_date": with_ctes(
        f"SELECT listing_id FROM calendar WHERE available = 't' AND date = DATE '{C.AVAILABLE_DATE}'", "calendar"
    ),
    "haversine_distance": with_ctes(
        f"""SELECT l.id, round({haversine('c.c_latitude', 'c.c_longitude', 'l.latitude', 'l.longitude')}, {FINE})
           AS distance_km
    FROM listings l CROSS JOIN chosen c""",
        "listings",
        "chosen",
    ),
    "common_amenities": with_ctes(
        """SELECT a.id, CAST(len(list_filter(a.amen, lambda x: list_contains(c.c_amenities, x))) AS BIGINT) AS common_amenities
    FROM amen_listings a CROSS JOIN chosen c""",
        "amen_listings",
        "chosen",
    ),
    "alternative_listings": _alternatives(False),
    "alternative_listings_map": _alternatives(True),
    "alternative_listings_with_self": _alternatives(False, True),
    "alternative_listings_near": _alternatives(False),
    "alternatives_all_pairs": _alternatives_all(),
}
