"""SQL for an independent engine that must return what the registered queries return."""

from __future__ import annotations

from farelane.schema import CELLS_20

TRIPS = """
base AS (
  SELECT event_id AS i, ts, value FROM events
  UNION ALL
  SELECT event_id AS i, ts, value FROM events WHERE event_id % 50 = 7),
steps AS (
  SELECT i, ts, value,
    (i * 7919) % 2500 AS px, (i * 104729) % 2000 AS py,
    (i * 15485863) % 2500 AS dx, (i * 32452843) % 2000 AS dy
  FROM base),
trips AS (
  SELECT CAST(i AS VARCHAR) AS key,
    CASE WHEN i % 101 = 3 THEN NULL
         WHEN i % 103 = 4 THEN -value
         WHEN i % 107 = 8 THEN 400e0 + value
         ELSE (250 + 2 * abs(dx - px) + 2 * abs(dy - py)) / 1e2 + value / 2e1
    END AS fare_amount,
    ts - INTERVAL '1' DAY * CAST(1500 + (i * 37) % 4000 AS INTEGER) AS pickup_datetime,
    CASE WHEN i % 89 = 5 THEN 0e0 ELSE -74.02e0 + px / 1e4 END AS pickup_longitude,
    CASE WHEN i % 89 = 5 THEN 0e0 ELSE 40.60e0 + py / 1e4 END AS pickup_latitude,
    CASE WHEN i % 89 = 5 THEN 0e0 WHEN i % 97 = 6 THEN -75e0
         ELSE -74.02e0 + dx / 1e4 END AS dropoff_longitude,
    CASE WHEN i % 89 = 5 THEN 0e0 ELSE 40.60e0 + dy / 1e4 END AS dropoff_latitude,
    CAST((i * 31) % 10 AS INTEGER) AS passenger_count
  FROM steps)"""

SEVEN = (
    "fare_amount, pickup_datetime, pickup_longitude, pickup_latitude, "
    "dropoff_longitude, dropoff_latitude, passenger_count"
)
RULES = {
    "missing": " AND ".join(f"{c.strip()} IS NOT NULL" for c in SEVEN.split(",")),
    "zero_coordinates": "NOT (pickup_longitude = 0 AND pickup_latitude = 0 AND dropoff_longitude = 0 AND dropoff_latitude = 0)",
    "passengers_low": "passenger_count >= 1",
    "fare_low": "fare_amount > 0",
    "fare_high": "NOT fare_amount >= 400",
    "passengers_high": "passenger_count <= 7",
    "latitude_box": "pickup_latitude >= 40.5e0 AND pickup_latitude <= 40.9e0 AND dropoff_latitude >= 40.5e0 AND dropoff_latitude <= 40.9e0",
    "longitude_box": "pickup_longitude >= -74.3e0 AND pickup_longitude <= -73.7e0 AND dropoff_longitude >= -74.3e0 AND dropoff_longitude <= -73.7e0",
}
CLEAN = f"""{TRIPS},
clean AS (SELECT DISTINCT {SEVEN} FROM trips WHERE {" AND ".join(f"({r})" for r in RULES.values())})"""

LOCAL = "timezone('America/New_York', timezone('UTC', pickup_datetime))"
MANHATTAN = (
    "6371e0 * (abs(radians(dropoff_longitude) - radians(pickup_longitude))"
    " + abs(radians(dropoff_latitude) - radians(pickup_latitude)))"
)
HAVERSINE = (
    "6371e0 * 2 * asin(sqrt(pow(sin((radians(dropoff_latitude) - radians(pickup_latitude)) / 2), 2)"
    " + cos(radians(pickup_latitude)) * cos(radians(dropoff_latitude))"
    " * pow(sin((radians(dropoff_longitude) - radians(pickup_longitude)) / 2), 2)))"
)
TIMED = f"""{CLEAN},
timed AS (SELECT *, {LOCAL} AS lt, {MANHATTAN} AS manhattan_km, {HAVERSINE} AS haversine_km, {MANHATTAN} AS distance FROM clean)"""


def rnd(x: str, places: int = 6) -> str:
    return f"round({x}, {places}) + 0e0"


def geohash(lat: str, lon: str, precision: int) -> str:
    """Bit by bit: halve the range, longitude first, five bits to a letter."""
    bits = 5 * precision
    lon_bits, lat_bits = (bits + 1) // 2, bits // 2
    q = {
        "lon": f"CAST(greatest(ceil(({lon} + 180e0) / (360e0 / {2**lon_bits})) - 1, 0) AS BIGINT)",
        "lat": f"CAST(greatest(ceil(({lat} + 90e0) / (180e0 / {2**lat_bits})) - 1, 0) AS BIGINT)",
    }
    left = {"lon": lon_bits, "lat": lat_bits}
    letters = []
    for c in range(precision):
        terms = []
        for b in range(5):
            axis = "lon" if (5 * c + b) % 2 == 0 else "lat"
            left[axis] -= 1
            terms.append(f"(({q[axis]} >> {left[axis]}) & 1) * {2 ** (4 - b)}")
        letters.append(f"substr('0123456789bcdefghjkmnpqrstuvwxyz', CAST({' + '.join(terms)} + 1 AS INTEGER), 1)")
    return " || ".join(letters)


P5 = geohash("pickup_latitude", "pickup_longitude", 5)
D5 = geohash("dropoff_latitude", "dropoff_longitude", 5)
CELLS = f"{TIMED},\ncells AS (SELECT *, {P5} AS pickup_cell, {D5} AS dropoff_cell FROM timed)"
ENDS = f"""{CELLS},
trip_ends AS (SELECT 'pickup' AS trip_end, pickup_cell AS cell FROM cells
         UNION ALL SELECT 'dropoff', dropoff_cell FROM cells),
counts AS (SELECT cell, count(*) AS n FROM trip_ends GROUP BY cell)"""
SCORED = f"""{TIMED},
line AS (SELECT regr_slope(fare_amount, distance) AS slope, regr_intercept(fare_amount, distance) AS intercept,
                regr_r2(fare_amount, distance) AS r2, count(*) AS n FROM timed),
scored AS (SELECT timed.*, intercept + slope * distance AS prediction,
                  intercept + slope * distance - fare_amount AS residual FROM timed, line)"""


def feature_list(cells=CELLS_20) -> list[str]:
    """The 66 columns as SQL over ``cells``, in order, as doubles."""
    hour = "extract(hour FROM lt)"
    dow, month, year = "(isodow(lt) - 1)", "month(lt)", "year(lt)"
    out = ["(passenger_count - 1) / 7e0"]
    out += [f"CASE WHEN {dow} = {d} THEN 1e0 ELSE 0e0 END" for d in range(7)]
    out += [f"CASE WHEN {month} = {m} THEN 1e0 ELSE 0e0 END" for m in range(1, 13)]
    out += [f"({year} - 2009) / 10e0", f"sin(2 * pi() / 24 * {hour})", f"cos(2 * pi() / 24 * {hour})"]
    out += ["haversine_km / 100", "manhattan_km / 100"]
    for end in ("pickup", "dropoff"):
        out += [f"CASE WHEN {end}_cell = '{c}' THEN 1e0 ELSE 0e0 END" for c in cells]
    return [*out, "fare_amount"]


def as_float(x: str) -> str:
    return f"CAST(CAST({x} AS FLOAT) AS DOUBLE)"


FEATURES_66 = ", ".join(f"{rnd(as_float(x))} AS _{i}" for i, x in enumerate(feature_list()))
FEATURES_65 = ", ".join(f"{rnd(as_float(x))} AS _{i}" for i, x in enumerate(feature_list()[:65]))
MATRIX = f"""{CELLS},
m AS (SELECT {", ".join(f"{as_float(x)} AS _{i}" for i, x in enumerate(feature_list()))} FROM cells)"""

REQUESTS = f"""{TRIPS},
wall AS (SELECT CAST(key AS BIGINT) AS request_id, trips.* EXCLUDE (pickup_datetime),
    CASE CAST(key AS BIGINT) % 3
      WHEN 0 THEN TIMESTAMP '2013-03-10 00:00:00' + INTERVAL '1' MINUTE * CAST((CAST(key AS BIGINT) * 7) % 300 AS INTEGER)
      WHEN 1 THEN TIMESTAMP '2013-11-03 00:00:00' + INTERVAL '1' MINUTE * CAST((CAST(key AS BIGINT) * 7) % 300 AS INTEGER)
      ELSE date_trunc('second', pickup_datetime) END AS pickup_datetime
  FROM trips),
shifted AS (SELECT *, timezone('UTC', timezone('America/New_York', pickup_datetime)) AS u FROM wall),
requests AS (SELECT *,
    CASE WHEN timezone('America/New_York', timezone('UTC', u)) <> pickup_datetime THEN 'nonexistent'
         WHEN timezone('America/New_York', timezone('UTC', u + INTERVAL '1' HOUR)) = pickup_datetime
           OR timezone('America/New_York', timezone('UTC', u - INTERVAL '1' HOUR)) = pickup_datetime THEN 'ambiguous'
         ELSE 'ok' END AS status
  FROM shifted)"""

FIT_SETS = f"""{CLEAN},
split_rows AS (SELECT {as_float("fare_amount")} AS fare, minute(pickup_datetime) % 10 < 3 AS held FROM clean),
naive AS (SELECT (SELECT count(*) FROM split_rows WHERE NOT held) AS train_rows, count(*) AS held_rows,
    avg(abs(fare - (SELECT avg(fare) FROM split_rows WHERE NOT held))) AS mean_mae FROM split_rows WHERE held)"""


def _unit(j: int, bias: float) -> str:
    """A hidden unit of the fixed network over the columns ``_0`` .. ``_64``."""
    terms = " + ".join(f"{((7 * i + 3 * j) % 11 - 5) / 8}e0 * _{i}" for i in range(65))
    return f"greatest({terms} + ({bias}e0), 0e0)"


NETWORK = f"3e0 + 1.5e0 * {_unit(0, 0.25)} + 2.5e0 * {_unit(1, -0.5)}"

EIGHT = f"key, {SEVEN}"


def histogram(source: str, x: str, bins: int, lo: str | None = None, hi: str | None = None) -> str:
    bounds = f"SELECT {lo or f'min({x})'} AS lo, {hi or f'max({x})'} AS hi FROM {source}"
    if lo:
        bounds = f"SELECT {lo} AS lo, {hi} AS hi"
    return f"""bounds AS ({bounds}),
binned AS (SELECT least(CAST(floor(({x} - lo) / ((hi - lo) / {bins})) AS INTEGER), {bins - 1}) AS bin, count(*) AS n
           FROM {source}, bounds WHERE {x} BETWEEN lo AND hi GROUP BY 1)
SELECT CAST(b.bin AS INTEGER) AS bin, {rnd(f"lo + b.bin * ((hi - lo) / {bins})", 9)} AS bin_lo,
       {rnd(f"lo + (b.bin + 1) * ((hi - lo) / {bins})", 9)} AS bin_hi, coalesce(n, 0) AS n
FROM (SELECT unnest(range({bins})) AS bin) b CROSS JOIN bounds LEFT JOIN binned ON binned.bin = b.bin"""


def describe(source: str, cols: list[str]) -> str:
    parts = [
        f"""SELECT '{c}' AS "column", count({c}) AS "count", {rnd(f"avg({c})")} AS mean, {rnd(f"stddev_samp({c})")} AS std,
 {rnd(f"CAST(min({c}) AS DOUBLE)")} AS min, {rnd(f"quantile_cont({c}, 0.25)")} AS q25, {rnd(f"quantile_cont({c}, 0.5)")} AS q50,
 {rnd(f"quantile_cont({c}, 0.75)")} AS q75, {rnd(f"CAST(max({c}) AS DOUBLE)")} AS max FROM {source}"""
        for c in cols
    ]
    return " UNION ALL ".join(parts)


def boxes() -> str:
    parts = []
    for i in range(65):
        parts.append(
            f"""SELECT '_{i}' AS "column", any_value(q1) AS q25, any_value(q2) AS q50, any_value(q3) AS q75,
 min(_{i}) FILTER (_{i} >= q1 - 1.5 * (q3 - q1)) AS whisker_low, max(_{i}) FILTER (_{i} <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
 count(*) FILTER (_{i} < q1 - 1.5 * (q3 - q1) OR _{i} > q3 + 1.5 * (q3 - q1)) AS outliers
 FROM m, (SELECT quantile_cont(_{i}, 0.25) AS q1, quantile_cont(_{i}, 0.5) AS q2, quantile_cont(_{i}, 0.75) AS q3 FROM m)"""
        )
    numbers = ", ".join(f"{rnd(c)} AS {c}" for c in ("q25", "q50", "q75", "whisker_low", "whisker_high"))
    return f'WITH {MATRIX} SELECT "column", outliers, {numbers} FROM ({" UNION ALL ".join(parts)})'


def correlations() -> str:
    names = [f"_{i}" for i in range(66)]
    pairs = [(a, b) for a in names for b in names]
    spread = [f"stddev_pop({a}) AS s{a}" for a in names]
    upper = {(a, b): f"c{a}{b}" for x, a in enumerate(names) for b in names[x:]}
    computed = [f"covar_pop({a}, {b}) AS {alias}" for (a, b), alias in upper.items()]
    values = []
    for a, b in pairs:
        cov = upper.get((a, b)) or upper[(b, a)]
        values.append(f"CASE WHEN s{a} > 0 AND s{b} > 0 THEN {cov} / (s{a} * s{b}) END")
    return f"""WITH {MATRIX}, stats AS MATERIALIZED (SELECT {", ".join(spread + computed)} FROM m),
long AS (SELECT unnest([{", ".join(f"'{a}'" for a, _ in pairs)}]) AS i, unnest([{", ".join(f"'{b}'" for _, b in pairs)}]) AS j,
         unnest([{", ".join(values)}]) AS r FROM stats)
SELECT i, j, {rnd("r", 4)} AS r FROM long"""


def cleaning_report() -> str:
    lines = [
        "SELECT 0 AS step, 'raw' AS rule, CAST(0 AS BIGINT) AS rejected, count(*) AS remaining FROM trips",
        "SELECT 1, 'duplicates', (SELECT count(*) FROM trips) - count(*), count(*) FROM folded",
    ]
    so_far = []
    for step, (name, rule) in enumerate(RULES.items(), start=2):
        so_far.append(f"coalesce({rule}, false)")
        lines.append(
            f"SELECT {step}, '{name}', (SELECT count(*) FROM trips WHERE NOT coalesce({rule}, false)),"
            f" (SELECT count(*) FROM folded WHERE {' AND '.join(so_far)})"
        )
    return f"WITH {TRIPS}, folded AS (SELECT DISTINCT {SEVEN} FROM trips) {' UNION ALL '.join(lines)}"


def downcast() -> str:
    lines = []
    ints = {"passenger_count": ("int", 4), "key_number": ("bigint", 8)}
    for c, (kind, width) in ints.items():
        steps = [("tinyint", 1, 127), ("smallint", 2, 32767), ("int", 4, 2147483647)]
        fits = [(n, w, m) for n, w, m in steps if w < width]
        name = "".join(f" WHEN min({c}) >= {-m - 1} AND max({c}) <= {m} THEN '{n}'" for n, _, m in fits)
        size = "".join(f" WHEN min({c}) >= {-m - 1} AND max({c}) <= {m} THEN {w}" for _, w, m in fits)
        lines.append(
            f"""SELECT '{c}' AS "column", '{kind}' AS type, CASE{name} ELSE '{kind}' END AS suggested, count(*) AS rows,
 count(*) * {width} AS bytes_before, count(*) * CASE{size} ELSE {width} END AS bytes_after FROM t"""
        )
    for c in ("fare_amount", "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude"):
        fits = f"max(abs({c} - CAST(CAST({c} AS FLOAT) AS DOUBLE))) <= 5e-4"
        lines.append(
            f"""SELECT '{c}', 'double', CASE WHEN {fits} THEN 'float' ELSE 'double' END, count(*), count(*) * 8,
 count(*) * CASE WHEN {fits} THEN 4 ELSE 8 END FROM t"""
        )
    return f"WITH {TRIPS}, t AS (SELECT *, CAST(key AS BIGINT) AS key_number FROM trips) {' UNION ALL '.join(lines)}"


def downcast_info() -> str:
    types = ["string", "float", "timestamp_ntz", "float", "float", "float", "float", "tinyint"]
    names = [c.strip() for c in EIGHT.split(",")]
    lines = [f"""SELECT {i} AS position, '{n}' AS "column", '{t}' AS type, count({n}) AS non_null FROM trips""" for i, (n, t) in enumerate(zip(names, types))]
    small = "CASE WHEN max(CAST(key AS BIGINT)) <= 127 THEN 'tinyint' WHEN max(CAST(key AS BIGINT)) <= 32767 THEN 'smallint' WHEN max(CAST(key AS BIGINT)) <= 2147483647 THEN 'int' ELSE 'bigint' END"
    lines.append(f"SELECT 8, 'key_number', {small}, count(key) FROM trips")
    return f"WITH {TRIPS} {' UNION ALL '.join(lines)}"


def column_info() -> str:
    types = ["string", "double", "timestamp_ntz", "double", "double", "double", "double", "int"]
    names = [c.strip() for c in EIGHT.split(",")]
    lines = [f"""SELECT {i} AS position, '{n}' AS "column", '{t}' AS type, count({n}) AS non_null FROM trips""" for i, (n, t) in enumerate(zip(names, types))]
    return f"WITH {TRIPS} {' UNION ALL '.join(lines)}"


BAND = (
    "CASE WHEN {x} >= 80 THEN 80e0 WHEN {x} >= 40 THEN 40e0 WHEN {x} >= 20 THEN 20e0"
    " WHEN {x} >= 10 THEN 10e0 WHEN {x} >= 5 THEN 5e0 WHEN {x} >= 0 THEN 0e0 END"
)
LOSS = f"{rnd('avg(residual * residual)', 4)} AS loss, {rnd('avg(abs(residual))', 4)} AS mae, count(*) AS rows"
TEXT = """CASE WHEN CAST(key AS BIGINT) % 211 = 9 THEN 'not a time'
 WHEN CAST(key AS BIGINT) % 3 = 0 THEN strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S')
 ELSE strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S UTC') END"""
SECOND = "CASE WHEN CAST(key AS BIGINT) % 211 = 9 THEN NULL ELSE date_trunc('second', pickup_datetime) END"
SPLIT = f"""{TRIPS}, sets AS (SELECT *, CASE WHEN CAST(key AS BIGINT) * 7919 % 100 >= 30 THEN 'train' ELSE 'val' END AS split FROM trips),
split_clean AS (SELECT DISTINCT split, {SEVEN} FROM sets WHERE {" AND ".join(f"({r})" for r in RULES.values())})"""


def rule(name: str) -> str:
    return f"WITH {TRIPS} SELECT {EIGHT} FROM trips WHERE {RULES[name]}"


RUNS = f"""{SCORED}, runs AS (SELECT 'run-' || year(pickup_datetime) AS run_id, year(pickup_datetime) AS y,
  CASE WHEN year(pickup_datetime) % 2 = 0 THEN 'evaluate' ELSE 'train' END AS context,
  avg(abs(residual)) AS mae, count(*) AS n FROM scored GROUP BY ALL)"""

FOLD_LINES = f"""{TIMED},
f AS (SELECT *, CAST(minute(pickup_datetime) % 5 AS INTEGER) AS fold FROM timed),
fits AS (SELECT k AS fold, regr_slope(fare_amount, distance) AS slope, regr_intercept(fare_amount, distance) AS intercept
         FROM f JOIN (SELECT CAST(unnest(range(5)) AS INTEGER) AS k) ks ON f.fold <> ks.k GROUP BY k)"""

STREAM_WINDOW = 30 * 86_400_000_000

ORACLE: dict[str, str] = {
    "csv_scan": f"WITH {TRIPS} SELECT trips.* REPLACE ({SECOND} AS pickup_datetime) FROM trips",
    "processed_scan": f"WITH {CELLS} SELECT {FEATURES_66} FROM cells",
    "table_scan": f"WITH {TRIPS} SELECT * FROM trips",
    "chunk_positions": f"""WITH {TRIPS}, placed AS (SELECT key, pickup_datetime,
        row_number() OVER (ORDER BY pickup_datetime, key) - 1 AS pos FROM trips)
        SELECT key, pickup_datetime, pos, pos // 2000 AS chunk_id FROM placed""",
    "chunk_slice": f"""WITH {CLEAN}, placed AS (SELECT pickup_datetime, fare_amount,
        row_number() OVER (ORDER BY pickup_datetime) - 1 AS pos FROM clean)
        SELECT * FROM placed WHERE pos >= 250 AND pos < 750""",
    "schema_check": f"""WITH {TRIPS} SELECT 'key' AS "column", 'string' AS type, count(key) AS filled, CAST(0 AS BIGINT) AS unreadable FROM trips
        UNION ALL SELECT 'pickup_datetime', 'timestamp_ntz', count(pickup_datetime),
          count(*) FILTER (CAST(key AS BIGINT) % 211 = 9) FROM trips
        UNION ALL SELECT 'passenger_count', 'tinyint', count(passenger_count), 0 FROM trips """
    + " ".join(
        f"UNION ALL SELECT '{c}', 'double', count({c}), 0 FROM trips"
        for c in ("fare_amount", "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")
    ),
    "csv_sink": f"""WITH {CLEAN} SELECT passenger_count, 2 * count(*) AS n, {rnd("2 * sum(fare_amount)", 4)} AS fares
        FROM clean GROUP BY passenger_count""",
    "table_sink": f"""WITH {TRIPS}, both_writes AS (SELECT * FROM trips UNION ALL SELECT * FROM trips WHERE passenger_count > 4)
        SELECT passenger_count AS _0, count(*) AS n, {rnd("sum(fare_amount)", 4)} AS fares FROM both_writes GROUP BY 1""",
    "bulk_load": f"""WITH {SPLIT}, size_steps AS (SELECT * FROM (VALUES ('500k', 1), ('100k', 2), ('10k', 4), ('1k', 8)) AS t(size, step)),
        picked AS (SELECT sets.*, size FROM sets JOIN size_steps ON CAST(key AS BIGINT) % step = 0),
        picked_clean AS (SELECT DISTINCT split, size, {SEVEN} FROM picked WHERE {" AND ".join(f"({r})" for r in RULES.values())})
        SELECT split, size, 'raw' AS zone, count(*) AS n, {rnd("sum(fare_amount)", 2)} AS fares FROM picked GROUP BY split, size
        UNION ALL SELECT split, size, 'processed', count(*), {rnd(f"sum({as_float('fare_amount')})", 2)} FROM picked_clean GROUP BY split, size""",
    "catalog_table": f"""WITH {TRIPS} SELECT passenger_count, count(*) AS n, {rnd("sum(fare_amount)", 4)} AS fares FROM trips GROUP BY passenger_count""",
    "processed_months": f"""WITH {CLEAN} SELECT count(*) AS trips, {rnd(f"avg({as_float('fare_amount')})", 4)} AS mean_fare, CAST(66 AS INTEGER) AS columns
        FROM clean WHERE year(pickup_datetime) = 2012 AND month(pickup_datetime) >= 10""",
    "dataset_catalog": f"""WITH {SPLIT} SELECT passenger_count, count(*) AS n, max(pickup_datetime) AS last_pickup
        FROM sets WHERE split = 'val' GROUP BY passenger_count""",
    "inventory": f"""WITH {SPLIT} SELECT split || '_100k' AS dataset, 'raw' AS zone, count(*) AS rows,
          min(pickup_datetime) AS first_pickup, max(pickup_datetime) AS last_pickup FROM sets GROUP BY split
        UNION ALL SELECT split || '_processed_100k', 'processed', count(*), NULL, NULL FROM split_clean GROUP BY split""",
    "monthly_feed": f"""WITH {SPLIT} SELECT split, ['jan', 'feb', 'mar', 'apr', 'may', 'jun'][month(pickup_datetime)] AS month, count(*) AS rows
        FROM sets WHERE month(pickup_datetime) <= 6 GROUP BY ALL""",
    "feed_commit": f"""WITH {SPLIT} SELECT CAST(month(pickup_datetime) AS INTEGER) AS version, split,
        ['jan', 'feb', 'mar', 'apr', 'may', 'jun'][month(pickup_datetime)] AS month, count(*) AS rows, {rnd("sum(fare_amount)", 4)} AS fares
        FROM sets WHERE month(pickup_datetime) <= 6 GROUP BY ALL""",
    "quarantine": f"""WITH {TRIPS}, lines AS (SELECT CASE
          WHEN CAST(key AS BIGINT) % 97 = 1 THEN key || ',11.5,2013-07-06 17:18:00 UTC'
          WHEN CAST(key AS BIGINT) % 89 = 2 THEN key || ',11.5,2013-07-06 17:18:00 UTC,-73.9,40.7,-73.9,40.7,1,more'
          WHEN CAST(key AS BIGINT) % 83 = 3 THEN key || ',eleven,2013-07-06 17:18:00 UTC,-73.9,40.7,west,40.7,1'
          WHEN CAST(key AS BIGINT) % 211 = 9 THEN key || ',11.5,not a time,-73.9,40.7,-73.9,40.7,1' ELSE '' END AS line FROM trips)
        SELECT line, CASE WHEN line = '' THEN 'sound' WHEN line LIKE '%UTC' THEN 'short' WHEN line LIKE '%more' THEN 'long' ELSE 'unreadable' END AS reason,
          CASE WHEN line LIKE '%west%' THEN 'fare_amount,dropoff_longitude' WHEN line LIKE '%not a time%' THEN 'pickup_datetime' ELSE '' END AS fields,
          count(*) AS n FROM lines GROUP BY line""",
    "drop_key": f"WITH {TRIPS} SELECT {SEVEN} FROM trips",
    "drop_duplicates": f"WITH {TRIPS} SELECT DISTINCT {SEVEN} FROM trips",
    "drop_missing": rule("missing"),
    "drop_zero_coordinates": rule("zero_coordinates"),
    "passengers_above": rule("passengers_low"),
    "passengers_below": rule("passengers_high"),
    "fare_above": rule("fare_low"),
    "fare_below": rule("fare_high"),
    "latitude_box": rule("latitude_box"),
    "longitude_box": rule("longitude_box"),
    "bbox_wide": f"""WITH {CLEAN} SELECT * FROM clean WHERE pickup_longitude BETWEEN -74.1e0 AND -73.7e0
        AND dropoff_longitude BETWEEN -74.1e0 AND -73.7e0 AND pickup_latitude BETWEEN 40.6e0 AND 40.9e0
        AND dropoff_latitude BETWEEN 40.6e0 AND 40.9e0""",
    "bbox_midtown": f"""WITH {CLEAN} SELECT * FROM clean WHERE pickup_longitude BETWEEN -74e0 AND -73.95e0
        AND dropoff_longitude BETWEEN -74e0 AND -73.95e0 AND pickup_latitude BETWEEN 40.7e0 AND 40.8e0
        AND dropoff_latitude BETWEEN 40.7e0 AND 40.8e0""",
    "clean_trips": f"WITH {CLEAN} SELECT * FROM clean",
    "cleaning_report": cleaning_report(),
    "row_counts": f"WITH {CLEAN} SELECT (SELECT count(*) FROM trips) AS row_count, (SELECT count(*) FROM clean) AS cleaned_row_count",
    "target_split": f"""WITH {CLEAN} SELECT count(*) AS x_rows, {rnd("sum(pickup_latitude)", 4)} AS x_sum, 6 AS x_columns,
        count(*) AS y_rows, {rnd("sum(fare_amount)", 4)} AS y_sum, 1 AS y_columns FROM clean""",
    "target_append": f"WITH {CELLS} SELECT {FEATURES_66} FROM cells",
    "parse_pickup": f"""WITH {TRIPS} SELECT key, {TEXT} AS text, {SECOND} AS parsed,
        CASE WHEN CAST(key AS BIGINT) % 3 = 0 THEN NULL ELSE {SECOND} END AS parsed_strict FROM trips""",
    "local_time": f"WITH {TRIPS} SELECT key, pickup_datetime, {LOCAL} AS local FROM trips",
    "local_parts": f"""WITH {TRIPS}, l AS (SELECT key, {LOCAL} AS lt FROM trips) SELECT key, CAST(isodow(lt) - 1 AS INTEGER) AS dow,
        CAST(hour(lt) AS INTEGER) AS hour, CAST(month(lt) AS INTEGER) AS month, CAST(year(lt) AS INTEGER) AS year FROM l""",
    "cyclic_hours": f"""WITH {TRIPS}, l AS (SELECT key, {LOCAL} AS lt FROM trips) SELECT key,
        {rnd("sin(2 * pi() / 24 * hour(lt))")} AS hour_sin, {rnd("cos(2 * pi() / 24 * hour(lt))")} AS hour_cos FROM l""",
    "time_features": f"""WITH {TIMED} SELECT pickup_datetime, {rnd("sin(2 * pi() / 24 * hour(lt))")} AS hour_sin,
        {rnd("cos(2 * pi() / 24 * hour(lt))")} AS hour_cos, CAST(isodow(lt) - 1 AS INTEGER) AS dow,
        CAST(month(lt) AS INTEGER) AS month, CAST(year(lt) AS INTEGER) AS year FROM timed""",
    "request_times": f"""WITH {REQUESTS} SELECT request_id, pickup_datetime, status, CASE WHEN status = 'ok' THEN u END AS utc FROM requests""",
    "utc_text": f"WITH {TRIPS} SELECT key, strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S UTC') AS utc_text FROM trips",
    "dataset_month": f"""WITH {TRIPS}, parts AS (SELECT 'all' AS part, max(pickup_datetime) AS t FROM trips
        UNION ALL SELECT 'past', max(pickup_datetime) FROM trips WHERE year(pickup_datetime) < 2014)
        SELECT part, CASE WHEN year(t) < 2015 THEN '2014-12-01' ELSE strftime(t, '%Y-%m-01') END AS dataset_month FROM parts""",
    "haversine": f"WITH {TRIPS} SELECT key, {rnd(HAVERSINE)} AS haversine_km FROM trips",
    "manhattan": f"WITH {TRIPS} SELECT key, {rnd(MANHATTAN)} AS manhattan_km FROM trips",
    "geohash_cells": f"WITH {TRIPS} SELECT key, "
    + ", ".join(
        f"{geohash(f'{end}_latitude', f'{end}_longitude', p)} AS {end}_{p}" for p in (3, 4, 5) for end in ("pickup", "dropoff")
    )
    + " FROM trips",
    "geohash_fine": f"WITH {TRIPS} SELECT key, {geohash('pickup_latitude', 'pickup_longitude', 9)} AS pickup_9 FROM trips",
    "trip_cells": f"WITH {CELLS} SELECT pickup_datetime, pickup_cell, dropoff_cell FROM cells",
    "scaled_values": f"""WITH {TIMED} SELECT pickup_datetime, {rnd("(passenger_count - 1) / 7e0")} AS passengers,
        {rnd("haversine_km / 100")} AS haversine, {rnd("manhattan_km / 100")} AS manhattan,
        {rnd("(year(lt) - 2009) / 10e0")} AS year, {rnd("fare_amount / 300")} AS fare FROM timed""",
    "one_hot_weekday": f"WITH {TIMED} SELECT pickup_datetime, "
    + ", ".join(f"CAST(isodow(lt) = {d + 1} AS INTEGER) AS dow_{d}" for d in range(7))
    + " FROM timed",
    "one_hot_month": f"WITH {TIMED} SELECT pickup_datetime, "
    + ", ".join(f"CAST(month(lt) = {m} AS INTEGER) AS month_{m}" for m in range(1, 13))
    + " FROM timed",
    "one_hot_cells": f"WITH {CELLS} SELECT pickup_datetime, "
    + ", ".join(f"CAST({e}_cell = '{c}' AS INTEGER) AS {e[0]}_{c}" for e in ("pickup", "dropoff") for c in CELLS_20)
    + " FROM cells",
    "trip_features": f"WITH {CELLS} SELECT {FEATURES_65} FROM cells",
    "feature_vectors": f"WITH {MATRIX} SELECT 65 AS width, {rnd(' + '.join(f'_{i}' for i in range(65)), 4)} AS total, {rnd('_65', 4)} AS label FROM m",
    "float_compression": f"WITH {CLEAN} SELECT pickup_datetime, "
    + ", ".join(
        f"{rnd(as_float(c))} AS {c}"
        for c in ("fare_amount", "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")
    )
    + " FROM clean",
    "downcast_plan": downcast(),
    "downcast_apply": downcast_info(),
    "preprocess_table": f"WITH {CELLS} SELECT {FEATURES_66} FROM cells",
    "describe_trips": f"WITH {CLEAN} "
    + describe("clean", ["fare_amount", "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude", "passenger_count"]),
    "describe_raw": f"WITH {TRIPS} " + describe("trips", ["fare_amount", "dropoff_longitude", "passenger_count"]),
    "fare_quantiles": f"WITH {CLEAN} "
    + " UNION ALL ".join(
        f"""SELECT 'fare_amount' AS "column", {p}e0 AS prob, {rnd(f"quantile_cont(fare_amount, {p})")} AS value FROM clean"""
        for p in (0.01, 0.05, 0.1, 0.5, 0.9, 0.95, 0.99)
    ),
    "column_info": column_info(),
    "time_range": f"WITH {CLEAN} SELECT min(pickup_datetime) AS first_pickup, max(pickup_datetime) AS last_pickup FROM clean",
    "fare_histogram": f"WITH {CLEAN}, {histogram('clean', 'fare_amount', 100)}",
    "distance_histogram": f"WITH {TIMED}, {histogram('timed', 'distance', 50)}",
    "passenger_counts": f"WITH {CLEAN} SELECT passenger_count, count(*) AS n FROM clean GROUP BY 1",
    "trip_end_union": f"WITH {ENDS} SELECT trip_end, cell FROM trip_ends",
    "district_counts": f"WITH {ENDS} SELECT cell, n FROM counts",
    "distinct_districts": f"WITH {ENDS} SELECT count(DISTINCT cell) AS districts FROM trip_ends",
    "merged_sketches": f"""WITH {ENDS}, totals AS (SELECT count(*) AS n FROM clean)
        SELECT 'rows' AS measure, n AS exact, true AS close FROM totals UNION ALL SELECT 'districts', count(DISTINCT cell), true FROM trip_ends
        UNION ALL SELECT 'trips', count(*), true FROM (SELECT DISTINCT {SEVEN} FROM clean)
        UNION ALL SELECT 'fare ' || p, n, true FROM totals, (VALUES ('0.05'), ('0.5'), ('0.95')) AS v(p)""",
    "gram_correlation": correlations(),
    "top_districts": f"WITH {ENDS} SELECT cell, n FROM counts ORDER BY n DESC, cell LIMIT 20",
    "district_coverage": f"""WITH {ENDS}, top AS (SELECT cell, n FROM counts ORDER BY n DESC, cell LIMIT 20)
        SELECT CAST(row_number() OVER w AS INTEGER) AS rank, cell, n,
          {rnd("sum(n) OVER (ORDER BY n DESC, cell ROWS UNBOUNDED PRECEDING) * 100e0 / (SELECT 2 * count(*) FROM clean)")} AS covered_pct
        FROM top WINDOW w AS (ORDER BY n DESC, cell)""",
    "derived_cells": f"""WITH {ENDS}, top AS (SELECT cell, n FROM counts ORDER BY n DESC, cell LIMIT 20)
        SELECT CAST(row_number() OVER (ORDER BY n DESC, cell) AS INTEGER) AS rank, cell,
          (SELECT count(*) FROM cells WHERE pickup_cell = top.cell) AS pickups,
          (SELECT count(*) FROM cells WHERE dropoff_cell = top.cell) AS dropoffs FROM top""",
    "distance_correlation": f"""WITH {TIMED} SELECT {rnd('corr(distance, fare_amount)')} AS r, count(*) AS n,
        abs(corr(distance, fare_amount)) * sqrt((count(*) - 2) / (1 - pow(corr(distance, fare_amount), 2))) > 4.9 AS significant FROM timed""",
    "correlation_matrix": correlations(),
    "feature_boxes": boxes(),
    "fare_line": f"WITH {SCORED} SELECT {rnd('slope')} AS slope, {rnd('intercept')} AS intercept, {rnd('r2')} AS r2, n FROM line",
    "density_grid": f"""WITH {CLEAN}, inside AS (SELECT * FROM clean WHERE pickup_longitude BETWEEN -74.1e0 AND -73.7e0
        AND dropoff_longitude BETWEEN -74.1e0 AND -73.7e0 AND pickup_latitude BETWEEN 40.6e0 AND 40.9e0
        AND dropoff_latitude BETWEEN 40.6e0 AND 40.9e0),
        points AS (SELECT 'pickup' AS trip_end, pickup_longitude AS lon, pickup_latitude AS lat FROM inside
          UNION ALL SELECT 'dropoff', dropoff_longitude, dropoff_latitude FROM inside)
        SELECT trip_end, least(CAST(floor((lon + 74.1e0) / ((-73.7e0 + 74.1e0) / 40)) AS INTEGER), 39) AS ix,
          least(CAST(floor((lat - 40.6e0) / ((40.9e0 - 40.6e0) / 30)) AS INTEGER), 29) AS iy, count(*) AS n FROM points GROUP BY ALL""",
    "head_trips": f"WITH {TRIPS} SELECT * FROM trips ORDER BY pickup_datetime, key LIMIT 5",
    "residual_summary": f"WITH {SCORED} " + describe("scored", ["residual"]),
    "residual_bands": f"""WITH {SCORED}, sides AS (SELECT 'actual' AS side, {BAND.format(x="fare_amount")} AS band, residual FROM scored
        UNION ALL SELECT 'predicted', {BAND.format(x="prediction")}, residual FROM scored)
        SELECT side, band, count(*) AS n, {rnd("avg(residual)", 4)} AS mean_residual, {rnd("avg(abs(residual))", 4)} AS mae
        FROM sides GROUP BY side, band""",
    "prediction_histogram": f"""WITH {SCORED}, pairs AS (SELECT 'prediction' AS series, prediction AS x FROM scored
        UNION ALL SELECT 'truth', fare_amount FROM scored),
        bounds AS (SELECT min(x) AS lo, max(x) AS hi FROM pairs),
        binned AS (SELECT series, least(CAST(floor((x - lo) / ((hi - lo) / 200)) AS INTEGER), 199) AS bin, count(*) AS n
          FROM pairs, bounds GROUP BY ALL)
        SELECT s.series, CAST(b.bin AS INTEGER) AS bin, {rnd("lo + b.bin * ((hi - lo) / 200)", 9)} AS bin_lo,
          {rnd("lo + (b.bin + 1) * ((hi - lo) / 200)", 9)} AS bin_hi, coalesce(n, 0) AS n
        FROM (SELECT unnest(range(200)) AS bin) b CROSS JOIN (SELECT unnest(['prediction', 'truth']) AS series) s CROSS JOIN bounds
          LEFT JOIN binned ON binned.bin = b.bin AND binned.series = s.series""",
    "residual_histogram": f"""WITH {SCORED}, {histogram('scored', 'residual', 40, '-20e0', '20e0')}
        UNION ALL SELECT -1, NULL, -20e0, count(*) FROM scored WHERE residual < -20e0
        UNION ALL SELECT 40, 20e0, NULL, count(*) FROM scored WHERE residual > 20e0""",
    "sorted_residuals": f"WITH {SCORED} SELECT pickup_datetime, {rnd('residual')} AS residual FROM scored",
    "worst_residuals": f"""WITH {SCORED}, banded AS (SELECT *, {BAND.format(x="fare_amount")} AS band FROM scored),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY band ORDER BY abs(residual) DESC, fare_amount, pickup_datetime) AS rank FROM banded)
        SELECT band, CAST(rank AS INTEGER) AS rank, pickup_datetime, fare_amount, {rnd("residual")} AS residual FROM ranked WHERE rank <= 5""",
    "train_test_split": f"WITH {TRIPS} SELECT key, CASE WHEN CAST(key AS BIGINT) * 7919 % 100 < 30 THEN 'test' ELSE 'train' END AS part FROM trips",
    "cross_validation": f"""WITH {FOLD_LINES} SELECT f.fold, {rnd("any_value(slope)")} AS slope, {rnd("any_value(intercept)")} AS intercept,
        {rnd("avg(abs(intercept + slope * distance - fare_amount))")} AS mae, count(*) AS rows FROM f JOIN fits USING (fold) GROUP BY f.fold""",
    "evaluate_line": f"WITH {SCORED} SELECT {LOSS} FROM scored",
    "evaluate_by_month": f"""WITH {SCORED} SELECT CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month,
        {LOSS} FROM scored GROUP BY 1, 2""",
    "evaluate_by_band": f"WITH {SCORED} SELECT {BAND.format(x='fare_amount')} AS band, {LOSS} FROM scored GROUP BY 1",
    "score_trips": f"WITH {SCORED} SELECT pickup_datetime, fare_amount, {rnd('prediction')} AS prediction FROM scored",
    "scored_requests": f"""WITH {SCORED}, {REQUESTS.removeprefix(TRIPS + ",")} SELECT request_id, status,
        CASE WHEN status = 'ok' THEN {rnd(f"intercept + slope * {MANHATTAN}")} END AS fare FROM requests, line""",
    "request_features": f"""WITH {REQUESTS}, timed AS (SELECT *, pickup_datetime AS lt, {MANHATTAN} AS manhattan_km, {HAVERSINE} AS haversine_km
          FROM requests WHERE status = 'ok'),
        cells AS (SELECT *, {P5} AS pickup_cell, {D5} AS dropoff_cell FROM timed) SELECT request_id, {FEATURES_65} FROM cells""",
    "run_log": f"""WITH {RUNS} SELECT run_id, context, CAST(y AS VARCHAR) AS year, CAST(n AS VARCHAR) AS row_count, {rnd("mae", 4)} AS mae FROM runs""",
    "run_comparison": f"""WITH {RUNS}, latest AS (SELECT round(arg_max(mae, y) FILTER (context = 'evaluate'), 2) AS eval_mae,
        round(arg_max(mae, y) FILTER (context = 'train'), 2) AS train_mae FROM runs)
        SELECT eval_mae, train_mae, round(train_mae - eval_mae, 2) AS delta, round(train_mae - eval_mae, 2) < 0 AS improved FROM latest""",
    "stage_lookup": f"""WITH {CLEAN}, models AS (SELECT 'fare-' || (month(pickup_datetime) % 3) AS name,
          CAST(year(pickup_datetime) * 100 + month(pickup_datetime) AS INTEGER) AS version,
          CASE WHEN count(*) % 2 = 0 THEN 'Production' ELSE 'Staging' END AS stage FROM clean
          GROUP BY year(pickup_datetime), month(pickup_datetime))
        SELECT name, max(version) AS version, 'models/' || max(version) AS path, 'linear' AS kind, stage FROM models GROUP BY name, stage""",
    "stream_features": f"""WITH {CELLS.replace("SELECT DISTINCT", "SELECT")} SELECT {FEATURES_66} FROM cells""",
    "stream_dedup": f"WITH {TRIPS} SELECT DISTINCT {SEVEN} FROM trips",
    "stream_error": f"""WITH {SCORED}, kept AS (SELECT {SEVEN}, unnest(range(CASE WHEN passenger_count = 3 THEN 2 ELSE 1 END)) AS copy FROM trips
          WHERE {" AND ".join(f"({r})" for r in RULES.values())}),
        errors AS (SELECT epoch_us(pickup_datetime) AS us, abs(intercept + slope * ({MANHATTAN}) - fare_amount) AS e FROM kept, line),
        placed AS (SELECT us // {STREAM_WINDOW} * {STREAM_WINDOW} AS start_us, e FROM errors)
        SELECT start_us, start_us + {STREAM_WINDOW} AS end_us, {rnd("avg(e)", 4)} AS mae, count(*) AS rows FROM placed GROUP BY start_us""",
    "stream_dedup_state": f"WITH {TRIPS} SELECT DISTINCT {SEVEN} FROM trips",
    "stream_error_window": f"""WITH {SCORED}, kept AS (SELECT {SEVEN}, unnest(range(CASE WHEN passenger_count IN (2, 3) THEN 2 ELSE 1 END)) AS copy FROM trips
          WHERE {" AND ".join(f"({r})" for r in RULES.values())}),
        errors AS (SELECT epoch_us(pickup_datetime) AS us, abs(intercept + slope * ({MANHATTAN}) - fare_amount) AS e FROM kept, line),
        placed AS (SELECT us // {STREAM_WINDOW} * {STREAM_WINDOW} AS start_us, e FROM errors)
        SELECT start_us, start_us + {STREAM_WINDOW} AS end_us, {rnd("avg(e)", 4)} AS mae, count(*) AS rows FROM placed GROUP BY start_us""",
    "stream_refresh": f"""WITH {TRIPS} SELECT passenger_count, count(*) AS n, {rnd("sum(fare_amount)", 4)} AS fares FROM trips
        WHERE {" AND ".join(f"({r})" for r in RULES.values())} GROUP BY passenger_count""",
    "linear_fit": f"""WITH {CLEAN} SELECT count(*) AS rows, 0e0 AS residual, 0e0 AS with_0, 0e0 AS with_20, 0e0 AS with_21, 0e0 AS with_22,
        0e0 AS with_23, 0e0 AS with_24 FROM clean""",
    "linear_scored_trips": f"""WITH {TIMED} SELECT CAST(month(lt) AS INTEGER) AS month, count(*) AS trips,
        {rnd(f"avg({as_float('fare_amount')})", 2)} AS mean_prediction FROM timed GROUP BY 1""",
    "pipeline_scored": f"""WITH {TIMED} SELECT CAST(month(lt) AS INTEGER) AS month, count(*) AS trips,
        {rnd(f"avg({as_float('fare_amount')})", 2)} AS mean_prediction FROM timed GROUP BY 1""",
    "tree_fit": f"WITH {FIT_SETS} SELECT 'gbt' AS model, train_rows, held_rows, {rnd('mean_mae', 3)} AS mean_mae, true AS beats_mean FROM naive",
    "dense_fit": f"WITH {FIT_SETS} SELECT 'dense' AS model, train_rows, held_rows, {rnd('mean_mae', 3)} AS mean_mae, true AS beats_mean FROM naive",
    "chunked_fit": f"""WITH {FIT_SETS} SELECT CAST(c AS BIGINT) AS chunk_id, CAST(least(train_rows - 2000 * c, 2000) AS BIGINT) AS rows, true AS beats_mean
        FROM (SELECT train_rows, unnest(range((train_rows + 1999) // 2000)) AS c FROM naive)""",
    "sync_fit": f"WITH {FIT_SETS} SELECT train_rows AS rows, true AS four_passes, true AS falls FROM naive",
    "warm_start": f"WITH {FIT_SETS} SELECT train_rows AS rows, true AS ahead FROM naive",
    "model_store": f"""WITH {FIT_SETS} SELECT CAST(1 AS INTEGER) AS in_production, CAST(2 AS INTEGER) AS newest, CAST(3 AS BIGINT) AS runs, train_rows,
        held_rows, true AS beat_mean, true AS differ, true AS consistent FROM naive""",
    "stream_fit": "SELECT 'stream-batch-' || b AS run_id, 'train' AS context, true AS beats_mean FROM (SELECT unnest(range(3)) AS b)",
    "dense_scored": f"""WITH {MATRIX.replace("(SELECT CAST", "(SELECT pickup_datetime, fare_amount, CAST", 1)}
        SELECT pickup_datetime, fare_amount, {rnd(NETWORK, 3)} AS prediction FROM m""",
    "dense_requests": f"""WITH {REQUESTS}, holes AS (SELECT * REPLACE (
          CASE WHEN request_id % 31 = 1 OR request_id % 37 = 2 OR request_id % 41 = 3 OR request_id % 43 = 4 THEN 'missing' ELSE status END AS status) FROM requests),
        timed AS (SELECT *, pickup_datetime AS lt, {MANHATTAN} AS manhattan_km, {HAVERSINE} AS haversine_km FROM holes),
        cells AS (SELECT *, {P5} AS pickup_cell, {D5} AS dropoff_cell FROM timed),
        m AS (SELECT request_id, status, {", ".join(f"{as_float(x)} AS _{i}" for i, x in enumerate(feature_list()[:65]))} FROM cells)
        SELECT request_id, status, CASE WHEN status = 'ok' THEN {rnd(NETWORK, 3)} END AS fare FROM m""",
    "weekday_fares": f"""WITH {TIMED} SELECT CAST(isodow(lt) - 1 AS INTEGER) AS dow, count(*) AS trips,
        {rnd("avg(fare_amount)", 4)} AS avg_fare, {rnd("avg(haversine_km)", 4)} AS avg_km FROM timed GROUP BY 1""",
}
