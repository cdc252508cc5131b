"""Queries over the registry tables: scans to records, rules, lookups, models and figures, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave import dims, vocabulary as v
from siteweave.functions import ratings, similarity as sim
from siteweave.functions.keys import key_part, record_key
from siteweave.operators import analytics, classify, evidence, lookups, power
from siteweave.operators.spatial import near_pairs
from siteweave.schemas import facility_rules, power_rules, violations
from siteweave.sources import nei, osm, peeringdb
from siteweave.plans.catalogue import Catalogue
from siteweave.storage import table

catalogue = Catalogue()
query = catalogue.query
QUERIES, SQL = catalogue.queries, catalogue.sql


def _values(rows) -> str:
    """Rows as a VALUES list."""
    one = lambda x: "NULL" if x is None else f"'{x}'" if isinstance(x, str) and "'" not in x else "'" + x.replace("'", "''") + "'" if isinstance(x, str) else repr(x)
    return "(VALUES " + ", ".join("(" + ", ".join(one(x) for x in r) + ")" for r in rows) + ")"


_NAN = lambda c: f"CASE WHEN isnan({c}) THEN NULL ELSE {c} END"
ALL_BOXES = [(r[0], *r[6]) for r in v.JURISDICTIONS] + [(c, *b) for c, b in v.EXTRA_BOXES]
_INSIDE = "(" + " OR ".join(f"(lon BETWEEN {x0} AND {x1} AND lat BETWEEN {y0} AND {y1})" for _, x0, y0, x1, y1 in ALL_BOXES) + ")"


# --- scans to records -------------------------------------------------------------------------


@query(f"""
WITH t AS (SELECT *, nullif(tags['addr:housenumber'], '') AS n, nullif(tags['addr:street'], '') AS s, substr(tags['start_date'], 1, 4) AS y FROM overpass_datacenters
           WHERE snapshot_date = (SELECT max(snapshot_date) FROM overpass_datacenters))
SELECT type || '/' || id AS source_id, coalesce(nullif(tags['name'], ''), nullif(tags['operator'], ''), nullif(tags['short_name'], '')) AS name, nullif(tags['operator'], '') AS operator_raw,
       nullif(concat_ws(' ', n, s), '') AS address, nullif(tags['addr:city'], '') AS city, CASE WHEN length(regexp_replace(y, '[^0-9]', '', 'g')) = 4 AND CAST(y AS INT) BETWEEN 1900 AND 2100 THEN CAST(y AS DOUBLE) END AS year_built,
       TRY_CAST(nullif(tags['building:levels'], '') AS DOUBLE) AS building_levels, nullif(tags['building'], '') IS NOT NULL AS is_building
FROM t WHERE CASE WHEN type = 'node' THEN lat IS NOT NULL AND lon IS NOT NULL ELSE len(geometry) > 0 END
""")
def osm_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapped elements of the latest snapshot as records."""
    latest = osm.latest_snapshot(table(spark, sf_dir, "overpass_datacenters"), "snapshot_date")
    return osm.to_records(latest).select("source_id", "name", "operator_raw", "address", "city", "year_built", "building_levels", "is_building")


_ASSIGN = f"""
zips AS (SELECT * FROM {_values(v.ZIP3_RANGES)} AS z(low, high, code)),
names AS (SELECT * FROM {_values([(r[0], r[1].upper()) for r in v.JURISDICTIONS])} AS n(code, full_name)),
boxes AS (SELECT * FROM {_values(ALL_BOXES)} AS b(code, x0, y0, x1, y1))
"""
_ASSIGNED = r"""coalesce(
  CASE WHEN regexp_full_match(upper(trim(coalesce(state, ''))), '[A-Z]{2}') THEN upper(trim(state)) END,
  (SELECT code FROM names WHERE full_name = upper(trim(state))),
  (SELECT code FROM names WHERE code = regexp_extract(upper(trim(zipcode)), '^([A-Z]{2})\b', 1)),
  (SELECT code FROM zips WHERE TRY_CAST(substr(regexp_extract(upper(trim(zipcode)), '^(?:[A-Z]{2}\s+)?([0-9]{5})(?:-[0-9]{4})?$', 1), 1, 3) AS INT) BETWEEN low AND high),
  (SELECT CASE WHEN count(DISTINCT code) = 1 THEN min(code) END FROM boxes WHERE longitude BETWEEN x0 AND x1 AND latitude BETWEEN y0 AND y1))"""


@query(f"""
WITH {_ASSIGN}
SELECT CAST(id AS VARCHAR) AS source_id, name, org_name AS operator_raw, nullif(concat_ws(' ', nullif(address1, ''), nullif(address2, '')), '') AS address, {_ASSIGNED} AS state,
       nullif(clli, '') AS clli, nullif(website, '') AS website, CAST(net_count AS DOUBLE) AS pdb_net_count
FROM peeringdb_fac WHERE coalesce(status, 'ok') = 'ok' AND latitude IS NOT NULL AND longitude IS NOT NULL AND snapshot_date = (SELECT max(snapshot_date) FROM peeringdb_fac)
""")
def peeringdb_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry facilities of the latest snapshot as records with an assigned state."""
    latest = osm.latest_snapshot(table(spark, sf_dir, "peeringdb_fac"), "snapshot_date")
    return peeringdb.to_records(latest).select("source_id", "name", "operator_raw", "address", "state", "clli", "website", "pdb_net_count")


@query(f"""
WITH {_ASSIGN}
SELECT coalesce({_ASSIGNED}, 'none') AS assigned_state, count(*) AS n FROM peeringdb_fac GROUP BY 1
""")
def assigned_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of all registry rows by the ordered fallback."""
    rows = lookups.assign_state(table(spark, sf_dir, "peeringdb_fac"), dims.zip3_ranges(spark), peeringdb.BOXES, "state", "zipcode", "latitude", "longitude")
    return rows.groupBy(F.coalesce("assigned_state", F.lit("none")).alias("assigned_state")).agg(F.count("*").alias("n"))


_GENERATOR = r"(scc LIKE '20100%' OR scc LIKE '20200%' OR regexp_matches(concat_ws(' ', unit_description, process_description), '(?i)\b(?:generator|gen\s?set|ic\s+engine|standby|emergency)\b'))"
_RATING = r"(?i)([0-9][0-9,]*(?:\.[0-9]+)?)\s*(KW|MW|KVA|BHP|HP)\b"
_KW = f"""(TRY_CAST(replace(regexp_extract(d, '{_RATING}', 1), ',', '') AS DOUBLE) * CASE upper(regexp_extract(d, '{_RATING}', 2)) WHEN 'KW' THEN 1.0 WHEN 'MW' THEN 1000.0 WHEN 'KVA' THEN 0.8 WHEN 'BHP' THEN 0.746 WHEN 'HP' THEN 0.746 END)"""


@query(f"""
WITH u AS (SELECT *, {_GENERATOR} AS gen, concat_ws(' ', unit_description, process_description) AS d FROM nei_units), k AS (SELECT *, {_KW} AS kw FROM u)
SELECT eis_facility_id AS source_id, CAST(count(*) FILTER (gen) AS INT) AS n_generator_units, CAST(count(*) AS INT) AS n_units_total, CAST(count(kw) FILTER (gen AND kw BETWEEN 50 AND 5000) AS INT) AS n_units_rated,
       round(coalesce(sum(kw) FILTER (gen AND kw BETWEEN 50 AND 5000), 0), 4) AS rated_kw_sum
FROM k GROUP BY 1
""")
def generator_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units, generators and parsed ratings of every permitted facility."""
    rows = nei.by_facility(table(spark, sf_dir, "nei_units"))
    return rows.select(F.col("eis_facility_id").alias("source_id"), "n_generator_units", "n_units_total", "n_units_rated", F.round("rated_kw_sum", 4).alias("rated_kw_sum"))


@query(f"SELECT unit_description, count(*) AS n, round(max(CASE WHEN kw BETWEEN 50 AND 5000 THEN kw END), 4) AS kw FROM (SELECT unit_description, {_KW} AS kw FROM (SELECT unit_description, unit_description AS d FROM nei_units)) GROUP BY 1")
def capacity_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rating in unit descriptions."""
    return table(spark, sf_dir, "nei_units").groupBy("unit_description").agg(F.count("*").alias("n")).select("unit_description", "n", F.round(ratings.rating_kw(F.col("unit_description")), 4).alias("kw"))


@query("""
WITH u AS (SELECT *, row_number() OVER (PARTITION BY eis_facility_id, eis_unit_id ORDER BY state, company_name, site_name, unit_description, process_description, scc, zip_code, address, unit_type, primary_naics_code) AS r FROM nei_units
           WHERE trim(primary_naics_code) IN ('518210', '541513'))
SELECT eis_facility_id, eis_unit_id, trim(unit_description) AS unit_description, trim(scc) AS scc FROM u WHERE r = 1
""")
def unit_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of the wanted industries, the first of each (facility, unit) in a stated order."""
    rows = table(spark, sf_dir, "nei_units").where(F.trim("primary_naics_code").isin(*v.NAICS))
    order = ["state", "company_name", "site_name", "unit_description", "process_description", "scc", "zip_code", "address", "unit_type", "primary_naics_code"]
    kept = analytics.keep_first(rows, ["eis_facility_id", "eis_unit_id"], order)
    return kept.select("eis_facility_id", "eis_unit_id", F.trim("unit_description").alias("unit_description"), F.trim("scc").alias("scc"))


# --- rules, operators, text --------------------------------------------------------------------


_RULE_CASE = "CASE " + " ".join(f"WHEN regexp_matches(t, '{p}') THEN '{n}'" for n, p in classify.RULES) + " END"


@query(f"SELECT coalesce({_RULE_CASE}, 'in_scope') AS rule, count(*) AS n FROM (SELECT concat_ws(' ', name, operator_raw) AS t FROM records) GROUP BY 1")
def exclusion_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1, A10: how many records each text rule takes, first match wins."""
    text = F.concat_ws(" ", "name", "operator_raw")
    return table(spark, sf_dir, "records").groupBy(F.coalesce(classify.first_rule(text), F.lit("in_scope")).alias("rule")).agg(F.count("*").alias("n"))


# Texts that each rule and class must see, and some that look like them but are none.
_SCOPE_TEXTS = (
    ("State University Data Center", None), ("Cal Poly Annex", None), ("Universal Hosting", None), ("Computer Room 3", None), ("Machine Roomba Works", None), ("US Post Office Annex", None), ("USPS Node", None),
    ("Fire Station 9 Server", "County of Marin"), ("St. Mary Hospital DC", None), ("Sutter Street Data Center", None), ("Clinical Data Works", None), ("Cisco Lab", None), ("Francisco Data Center", None),
    ("Charter Communications Hub", None), ("Toll Center 4", None), ("Main Telephone Exchange", None), ("Toll Centerville", None), ("Equinix SV1", "Equinix"), ("Azure West", "Microsoft"), ("Santa Clara VII", "Vantage Data Centers"),
    ("Central Office", "AT&T"), ("Hub", "Verizon"), (None, None), ("", "Unknown Body"), ("Public Library Switching Centre", "Lumen Technologies"),
)


def _listed(names: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


@query(f"""
WITH t AS (SELECT * FROM {_values([(k, *row) for k, row in enumerate(_SCOPE_TEXTS)])} AS t(k, name, operator) UNION ALL SELECT -1 - row_id, name, operator_raw FROM records),
c AS (SELECT *, concat_ws(' ', name, operator) AS t, CASE WHEN operator IN {_listed(v.HYPERSCALE)} THEN 'hyperscale' WHEN operator IN {_listed(v.WHOLESALE)} THEN 'wholesale' WHEN operator IN {_listed(v.COLOCATION)} THEN 'colocation'
      WHEN operator IN {_listed(v.TELECOM)} OR regexp_matches(name, '{classify.TELECOM_NAME}') THEN 'telecom' ELSE 'unknown' END AS facility_class FROM t)
SELECT k, facility_class, coalesce({_RULE_CASE}, CASE WHEN facility_class = 'telecom' THEN 'telecom_central_office' END) AS exclusion_rule FROM c
""")
def scope_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """class and rule of planted texts that make every rule fire, and of all records."""
    planted = spark.createDataFrame([(k, *row) for k, row in enumerate(_SCOPE_TEXTS)], "k bigint, name string, operator_raw string")
    given = planted.unionByName(table(spark, sf_dir, "records").select((-1 - F.col("row_id")).alias("k"), "name", "operator_raw"))
    rows = given.withColumns({"operator": F.col("operator_raw"), "source": F.lit("osm")})
    return classify.classify(rows, F.lit(True)).select("k", "facility_class", "exclusion_rule")


# Operator texts in permit and registry style.
_SAMPLE_NAMES = (
    "Equinix, Inc.", "QTS Santa Clara 1", "Totally Unknown Entity Xyz", "RAGING WIRE", "DRT LAX10", "CYXTERA COMMUNICATIONS  LLC SC4-5", "Level(3) Los Angeles", "XERES VENTURES, LP (SC1)",
    "2805 LAFAYETTE", "VDC V", "1101 SPACE PARK PARTNERS  LLC", "AT&T Switching Center", "Primerica Financial", "   ", "AMAZON DATA SERVICES, INC.", "GOOGLE LLC", "Switch", "Prime", "H5",
)
_KEY = "trim(regexp_replace(regexp_replace(regexp_replace(lower(raw), '[^a-z0-9& ]', ' ', 'g'), '\\b(?:" + "|".join(v.OPERATOR_NOISE) + ")\\b', ' ', 'g'), ' +', ' ', 'g'))"
_ALIAS_ROWS = []
for _canonical, _alias in v.OPERATOR_ALIASES:
    for _raw in (_alias, _canonical):
        _ALIAS_ROWS.append((_raw, _canonical, len(_ALIAS_ROWS)))


@query(f"""
WITH a0 AS (SELECT raw, canonical, o, {_KEY} AS key FROM {_values(_ALIAS_ROWS)} AS a(raw, canonical, o)),
a1 AS (SELECT key, canonical, 2 * o AS o FROM a0 UNION ALL SELECT replace(key, ' ', ''), canonical, 2 * o + 1 FROM a0),
aliases AS (SELECT key AS alias, arg_min(canonical, o) AS canonical, min(o) AS o FROM a1 WHERE key <> '' GROUP BY 1),
spv AS (SELECT {_KEY} AS pattern FROM {_values([(p,) for p in v.UNATTRIBUTED])} AS p(raw)),
names AS (SELECT DISTINCT raw FROM (SELECT company_name AS raw FROM nei_units UNION ALL SELECT raw FROM {_values([(n,) for n in _SAMPLE_NAMES])} AS s(raw))),
keyed AS (SELECT raw, CASE WHEN trim(raw) <> '' THEN nullif({_KEY}, '') END AS key FROM names),
e AS (SELECT k.raw, k.key, coalesce(x.canonical, y.canonical) AS exact, EXISTS (SELECT 1 FROM spv WHERE contains(k.key, pattern) OR contains(pattern, k.key)) AS is_spv
      FROM keyed k LEFT JOIN aliases x ON x.alias = k.key LEFT JOIN aliases y ON y.alias = replace(k.key, ' ', '')),
t AS (SELECT e.raw, arg_max(canonical, length(replace(alias, ' ', '')) * 100000 - o) AS token FROM e JOIN aliases ON contains(' ' || e.key || ' ', ' ' || alias || ' ') AND (contains(alias, ' ') OR length(alias) >= 3) GROUP BY 1)
SELECT e.raw AS operator_raw, CASE WHEN e.key IS NOT NULL THEN coalesce(exact, CASE WHEN is_spv THEN '{v.UNATTRIBUTED_LABEL}' END, token, trim(e.raw)) END AS operator,
       CASE WHEN e.key IS NULL THEN 'unresolved' WHEN exact IS NOT NULL THEN 'alias' WHEN is_spv THEN 'unattributed' WHEN token IS NOT NULL THEN 'alias_token' ELSE 'unresolved' END AS operator_confidence
FROM e LEFT JOIN t ON t.raw = e.raw
""")
def operator_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator texts by exact key, joined key, property vehicles, whole-word containment."""
    names = table(spark, sf_dir, "nei_units").select(F.col("company_name").alias("operator_raw")).unionByName(spark.createDataFrame([(n,) for n in _SAMPLE_NAMES], "operator_raw string")).distinct()
    return lookups.resolve_operators(names, "operator_raw", dims.operator_aliases(spark), dims.unattributed(spark)).select("operator_raw", "operator", "operator_confidence")


@query(f"""
WITH f AS (SELECT *, CASE WHEN isnan(lat) THEN NULL ELSE lat END AS la, CASE WHEN isnan(lon) THEN NULL ELSE lon END AS lo FROM facilities)
SELECT coalesce({_INSIDE.replace('lon BETWEEN', 'lo BETWEEN').replace('lat BETWEEN', 'la BETWEEN')}, false) AS inside, count(*) AS n FROM f GROUP BY 1
""")
def bbox_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """facilities inside the union of boxes; a missing position is outside."""
    from siteweave.plans.build import ALL_BOXES as boxes

    rows = table(spark, sf_dir, "facilities").select(F.nanvl("lat", F.lit(None).cast("double")).alias("lat"), F.nanvl("lon", F.lit(None).cast("double")).alias("lon"))
    return rows.groupBy(lookups.in_any_box(F.col("lat"), F.col("lon"), boxes).alias("inside")).agg(F.count("*").alias("n"))


_CODES = r"list_sort(list_distinct(list_filter(string_split(regexp_replace(lower({c}), '[^a-z0-9 ]+', ' ', 'g'), ' '), lambda w: regexp_full_match(w, '[a-z]{{2,4}}[0-9]{{1,3}}[a-z]?'))))"
_SHORT = "array_to_string(list_transform(list_filter(string_split(regexp_replace(lower(coalesce({c}, '')), '[^a-z0-9 ]+', ' ', 'g'), ' '), lambda w: w <> ''), lambda w: CASE w " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in v.STREET_SHORT.items()) + " ELSE w END), ' ')"


@query(f"""
WITH r AS (SELECT review_id, coalesce({_CODES.format(c="left_name")}, []) AS lc, coalesce({_CODES.format(c="right_name")}, []) AS rc, {_SHORT.format(c="left_address")} AS la, {_SHORT.format(c="right_address")} AS ra FROM dedupe_review)
SELECT review_id, array_to_string(lc, ',') AS left_codes, la AS left_address, CASE WHEN len(lc) > 0 AND len(rc) > 0 AND NOT list_has_any(lc, rc) THEN 'distinct_site_codes'
       WHEN nullif(regexp_extract(la, '^([0-9]+)', 1), '') <> nullif(regexp_extract(ra, '^([0-9]+)', 1), '') THEN 'distinct_street_numbers' END AS forbidden FROM r
""")
def cannot_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes, short addresses and what forbids a reviewed pair."""
    rows = table(spark, sf_dir, "dedupe_review").select("review_id", sim.code_tokens(F.col("left_name")).alias("lc"), sim.code_tokens(F.col("right_name")).alias("rc"), sim.short_address(F.col("left_address")).alias("la"), sim.short_address(F.col("right_address")).alias("ra"))
    why = sim.cannot_link(F.col("lc"), F.col("rc"), sim.street_number(F.col("la")), sim.street_number(F.col("ra")))
    return rows.select("review_id", F.array_join(F.array_sort("lc"), ",").alias("left_codes"), F.col("la").alias("left_address"), why.alias("forbidden"))


@query(r"""
WITH r AS (SELECT review_id, distance, name, address, operator, coalesce(CASE WHEN isnan(distance_m) THEN NULL ELSE distance_m END, 0) AS m, left_name IS NOT NULL AND right_name IS NOT NULL AS b,
  coalesce(len(list_intersect(string_split(regexp_extract(codes, '^\[([^\]]*)\]', 1), ','), string_split(regexp_extract(codes, '\|\[([^\]]*)\]$', 1), ','))) > 0 AND NOT contains(codes, '[]'), false) AS c FROM dedupe_review),
s AS (SELECT *, 0.34 * distance + 0.24 * name + 0.22 * address + 0.20 * operator AS x FROM r),
f AS (SELECT *, greatest(x, CASE WHEN c THEN 0.82 ELSE x END, CASE WHEN operator >= 0.99 AND m <= 250 THEN 0.80 ELSE x END, CASE WHEN operator >= 0.99 AND address >= 0.90 THEN 0.82 ELSE x END) AS y FROM s)
SELECT review_id, round(least(CASE WHEN b AND operator < 0.55 AND m > 150 THEN least(y, 0.45) ELSE y END, 1), 6) AS score FROM f
""")
def composite_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weighted score with its floors and cap over stored components and the codes that both sides have."""
    codes = lambda pattern: F.filter(F.split(F.regexp_extract(F.coalesce("codes", F.lit("")), pattern, 1), ","), lambda c: c != "")
    shared = F.arrays_overlap(codes(r"^\[([^\]]*)\]"), codes(r"\|\[([^\]]*)\]$"))
    metres = F.coalesce(F.nanvl("distance_m", F.lit(None).cast("double")), F.lit(0.0))
    both = F.col("left_name").isNotNull() & F.col("right_name").isNotNull()
    score = sim.pair_score(F.col("distance"), F.col("name"), F.col("address"), F.col("operator"), shared, both, metres)
    return table(spark, sf_dir, "dedupe_review").select("review_id", F.round(score, 6).alias("score"))


@query()
def block_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The block ratio of reviewed addresses, an Arrow kernel."""
    from siteweave.storage import ship

    ship(spark)
    rows = table(spark, sf_dir, "dedupe_review")
    return rows.select("review_id", F.round(sim.block_ratio(sim.short_address(F.col("left_address")), sim.short_address(F.col("right_address"))), 6).alias("ratio"))


_TOKENS = "list_distinct(list_filter(string_split(regexp_replace(lower(coalesce({c}, '')), '[^a-z0-9 ]+', ' ', 'g'), ' '), lambda w: w <> '' AND w NOT IN (" + ", ".join(f"'{w}'" for w in v.NAME_STOPWORDS) + ")))"


@query(f"""
WITH r AS (SELECT review_id, {_TOKENS.format(c="left_name")} AS a, {_TOKENS.format(c="right_name")} AS b FROM dedupe_review)
SELECT review_id, round(CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0 ELSE len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) END, 6) AS jaccard FROM r
""")
def name_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token overlap of the names of reviewed pairs."""
    overlap = sim.jaccard(sim.name_tokens(F.col("left_name")), sim.name_tokens(F.col("right_name")))
    return table(spark, sf_dir, "dedupe_review").select("review_id", F.round(overlap, 6).alias("jaccard"))


@query("""
WITH f AS (SELECT facility_id, lat, lon FROM facilities WHERE lat IS NOT NULL AND lon IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lon) AND NOT (lat = 0 AND lon = 0)),
p AS (SELECT a.facility_id AS l, b.facility_id AS r, 2 * 6371008.8 * asin(least(1, sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))) AS m
      FROM f a JOIN f b ON a.facility_id < b.facility_id AND abs(a.lat - b.lat) < 0.0095)
SELECT l AS left_id, r AS right_id, round(CASE WHEN m <= 60 THEN 1 ELSE greatest(0, 1 - (m - 60) / 940) END, 4) AS credit FROM p WHERE m <= 1000
""")
def blocked_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facilities within a kilometre by a grid join, with the credit for their distance."""
    points = table(spark, sf_dir, "facilities").select(F.col("facility_id").alias("id"), "lat", "lon")
    return near_pairs(points, 1000.0).select("left_id", "right_id", F.round(sim.distance_credit(F.col("distance_m")), 4).alias("credit"))


@query("""
WITH s AS (SELECT facility_id, lat, lon, coalesce(nullif(substr(regexp_replace(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 44), ''), 'facility') AS slug FROM facilities WHERE NOT isnan(lat) AND NOT isnan(lon))
SELECT facility_id, slug || '-' || substr(sha1(slug || '|' || printf('%.5f', lat) || '|' || printf('%.5f', lon)), 1, 6) AS made FROM s
""")
def facility_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X11: the ids of facilities with a position, made anew: slug of the name and digest of slug and position."""
    rows = table(spark, sf_dir, "facilities").where(F.col("lat").isNotNull() & F.col("lon").isNotNull() & ~F.isnan("lat") & ~F.isnan("lon"))
    return rows.select("facility_id", sim.facility_id(F.col("name"), F.col("lat"), F.col("lon")).alias("made"))


_MENTION = r"(?i)([^.\n]{0,140}?)([0-9][0-9,]*(?:\.[0-9]+)?)\s*(?:MW|megawatts?)([^.\n]{0,140})"
_HINT = r"(?i)\b(?:load|demand|capacity|connected|critical|it\s+load|power|electrical|substation|service|utility)\b"


@query(f"""
WITH m AS (SELECT doc_id, unnest(regexp_extract_all(text, '{_MENTION}', 1)) AS b, unnest(regexp_extract_all(text, '{_MENTION}', 2)) AS n, unnest(regexp_extract_all(text, '{_MENTION}', 3)) AS a FROM documents),
x AS (SELECT doc_id, TRY_CAST(replace(n, ',', '') AS DOUBLE) AS mw, lower(concat_ws(' ', b, a)) AS w FROM m)
SELECT doc_id, count(*) AS mentions, round(sum(mw), 3) AS total_mw, count(*) FILTER (contains(w, 'critical') OR contains(w, 'it load')) AS critical FROM x WHERE mw BETWEEN 0.5 AND 1500 AND regexp_matches(w, '{_HINT}') GROUP BY 1
""")
def mw_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Power figures with words about load around them in document texts."""
    found = table(spark, sf_dir, "documents").select("doc_id", F.explode(ratings.power_mentions(F.col("text"))).alias("m"))
    return found.groupBy("doc_id").agg(F.count("*").alias("mentions"), F.round(F.sum("m.value_mw"), 3).alias("total_mw"), F.count_if(F.col("m.basis") == "critical_load").alias("critical"))


# --- consolidation -----------------------------------------------------------------------------


_LINKED = """l AS (SELECT DISTINCT trim(facility_id) AS facility_id, lower(trim(source)) AS src, lower(trim(source_id)) AS sid FROM facility_sources),
v AS (SELECT * FROM (SELECT *, lower(trim(source)) AS src, lower(trim(source_id)) AS sid, row_number() OVER (PARTITION BY lower(trim(source)), lower(trim(source_id)) ORDER BY updated_at DESC, row_id DESC) AS r FROM records) WHERE r = 1)"""


def _linked(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Links with the given columns of each record's valid delivery; no other column is read or shuffled."""
    links = table(spark, sf_dir, "facility_sources").select(F.trim("facility_id").alias("facility_id"), key_part(F.col("source")).alias("src"), key_part(F.col("source_id")).alias("sid")).distinct()
    rows = table(spark, sf_dir, "records").select(key_part(F.col("source")).alias("src"), key_part(F.col("source_id")).alias("sid"), "updated_at", "row_id", *columns)
    newest = rows.groupBy("src", "sid").agg(F.max_by(F.struct(*columns), F.struct("updated_at", "row_id")).alias("r")).select("src", "sid", "r.*")
    return links.join(newest, ["src", "sid"])


@query(f"""
WITH {_LINKED}, m AS (SELECT l.facility_id, l.src, l.sid, CASE l.src WHEN 'peeringdb' THEN 0 WHEN 'osm' THEN 1 WHEN 'ceqanet' THEN 2 WHEN 'epa_nei' THEN 3 WHEN 'epa_frs' THEN 4 ELSE 99 END AS p, v.clli, v.website, v.postcode, v.footprint_sqm, v.pdb_net_count FROM l JOIN v USING (src, sid))
SELECT facility_id, arg_min(clli, printf('%02d|%s|%s', p, src, sid)) FILTER (clli IS NOT NULL) AS clli, arg_min(website, printf('%02d|%s|%s', p, src, sid)) FILTER (website IS NOT NULL) AS website,
       arg_min(postcode, printf('%02d|%s|%s', p, src, sid)) FILTER (postcode IS NOT NULL) AS postcode, max(footprint_sqm) FILTER (NOT isnan(footprint_sqm)) AS footprint_sqm, max(pdb_net_count) FILTER (NOT isnan(pdb_net_count)) AS pdb_net_count,
       string_agg(DISTINCT src, ',' ORDER BY src) AS source_list, CAST(count(DISTINCT src) AS INT) AS n_sources FROM m GROUP BY 1
""")
def pick_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each column of a facility from its most trusted record that has it, largest measures, its sources."""
    rank = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in v.SOURCE_PRIORITY.items() for x in pair]), F.col("src")), F.lit(v.OTHER_PRIORITY))
    rows = _linked(spark, sf_dir, "clli", "website", "postcode", "footprint_sqm", "pdb_net_count").withColumn("prio", rank)
    best = lambda c: F.expr(f"min_by({c}, struct(prio, src, sid)) FILTER (WHERE {c} IS NOT NULL)").alias(c)
    most = lambda c: F.max(F.nanvl(c, F.lit(None).cast("double"))).alias(c)
    return rows.groupBy("facility_id").agg(best("clli"), best("website"), best("postcode"), most("footprint_sqm"), most("pdb_net_count"), F.array_join(F.array_sort(F.collect_set("src")), ",").alias("source_list"), F.count_distinct("src").cast("int").alias("n_sources"))


@query(f"""
WITH {_LINKED} SELECT l.facility_id, arg_max(l.src || '|' || l.sid, printf('%020.4f|%s|%s', v.footprint_sqm, l.src, l.sid)) AS anchor FROM l JOIN v USING (src, sid) WHERE v.footprint_sqm IS NOT NULL AND NOT isnan(v.footprint_sqm) AND v.footprint_sqm > 0 GROUP BY 1
""")
def anchor_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: the record with the largest footprint of every facility."""
    rows = _linked(spark, sf_dir, "footprint_sqm").where(F.nanvl("footprint_sqm", F.lit(None).cast("double")) > 0)
    return rows.groupBy("facility_id").agg(F.max_by(F.concat_ws("|", "src", "sid"), F.struct("footprint_sqm", "src", "sid")).alias("anchor"))


_FLEET = f"""u AS (SELECT *, {_GENERATOR} AS gen, concat_ws(' ', unit_description, process_description) AS d FROM nei_units), k AS (SELECT *, {_KW} AS kw FROM u),
inv AS (SELECT lower(trim(eis_facility_id)) AS sid, count(*) FILTER (gen) AS g, count(kw) FILTER (gen AND kw BETWEEN 50 AND 5000) AS rated, coalesce(sum(kw) FILTER (gen AND kw BETWEEN 50 AND 5000), 0) AS kw FROM k GROUP BY 1),
lk AS (SELECT DISTINCT trim(facility_id) AS facility_id, lower(trim(source_id)) AS sid FROM facility_sources WHERE lower(trim(source)) = 'epa_nei')"""


def _inventory(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    units = table(spark, sf_dir, "nei_units").withColumn("eis_facility_id", key_part(F.col("eis_facility_id")))
    inventory = nei.by_facility(units).select(F.col("eis_facility_id").alias("source_id"), "n_generator_units", "n_units_rated", "rated_kw_sum")
    links = table(spark, sf_dir, "facility_sources").select(F.trim("facility_id").alias("facility_id"), key_part(F.col("source")).alias("source"), key_part(F.col("source_id")).alias("source_id")).distinct()
    return links, inventory


@query(f"""
WITH {_FLEET}, fl AS (SELECT facility_id, sum(g) AS n FROM lk LEFT JOIN inv USING (sid) GROUP BY 1)
SELECT f.facility_id, CAST(coalesce(n, 0) AS BIGINT) AS fleet_units, CASE WHEN source_list = 'epa_nei' AND coalesce(n, 0) < 4 THEN 'nei_only_insufficient_generator_fleet' END AS exclusion_rule FROM facilities f LEFT JOIN fl USING (facility_id)
""")
def fleet_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facilities known from permits only, by the size of their fleet."""
    links, inventory = _inventory(spark, sf_dir)
    return classify.fleet_gate(table(spark, sf_dir, "facilities"), links, inventory).select("facility_id", F.col("fleet_units").cast("bigint").alias("fleet_units"), "exclusion_rule")


# --- models and totals -------------------------------------------------------------------------


_PRIORS = f"priors AS (SELECT * FROM {_values([(*r, k) for k, r in enumerate(v.DENSITY_PRIORS)])} AS p(cls, y0, y1, wl, wm, wh, pl, pm, ph, o))"
_PRIOR = """pf AS (SELECT f.*, p.* FROM f JOIN priors p ON p.o = coalesce((SELECT min(o) FROM priors q WHERE q.cls = CASE WHEN f.c IN (SELECT cls FROM priors) THEN f.c ELSE 'unknown' END AND coalesce(f.y, 2012) BETWEEN q.y0 AND q.y1),
  (SELECT min(o) FROM priors q WHERE q.cls = CASE WHEN f.c IN (SELECT cls FROM priors) THEN f.c ELSE 'unknown' END)))"""
_FAC = "f AS (SELECT facility_id, facility_class AS c, year_built AS y, CASE WHEN footprint_sqft > 0 AND NOT isnan(footprint_sqft) THEN footprint_sqft END AS ft, CASE WHEN building_levels_reported BETWEEN 1 AND 200 THEN building_levels_reported ELSE 1 END AS lv FROM facilities)"


def _facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = lambda c: F.nanvl(c, F.lit(None).cast("double"))
    rows = table(spark, sf_dir, "facilities")
    numeric = ("lat", "lon", "building_levels_reported", "footprint_sqft", "best_power_mw", "power_ci_low_mw", "power_ci_high_mw", "est_annual_gwh")
    return rows.withColumns({c: clean(F.col(c)) for c in numeric})


@query(f"WITH {_PRIORS}, {_FAC}, {_PRIOR} SELECT facility_id, CAST(wm AS DOUBLE) AS w_mid, CAST(pm AS DOUBLE) AS pue_mid FROM pf")
def prior_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The density row of each facility's class and year."""
    rows = table(spark, sf_dir, "facilities").withColumn("p", lookups.prior_of(F.col("facility_class"), F.col("year_built")))
    return rows.select("facility_id", F.col("p.w_mid").alias("w_mid"), F.col("p.pue_mid").alias("pue_mid"))


_AREA = """c AS (SELECT facility_id, 'C_area' AS method, ft * least(lv, 3) * 0.60 * wm / 1e6 AS mw, (CASE WHEN lv > 3 THEN ft ELSE ft * lv END) * 0.45 * wl / 1e6 AS lo, ft * least(lv, 3) * 0.72 * wh / 1e6 AS hi, ft * least(lv, 3) * 0.60 * wm / 1e6 * pm * 0.70 * 8760 / 1000 AS gwh,
      (CASE WHEN lv > 3 THEN ft ELSE ft * lv END) * 0.45 * wl / 1e6 * pl * 0.55 * 8760 / 1000 AS gwh_low, ft * least(lv, 3) * 0.72 * wh / 1e6 * ph * 0.85 * 8760 / 1000 AS gwh_high FROM pf WHERE ft > 0)"""


def _area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return power.area_estimates(power.gross_area(_facilities(spark, sf_dir), levels="building_levels_reported"))


@query(f"WITH {_PRIORS}, {_FAC}, {_PRIOR}, {_AREA} SELECT facility_id, round(mw + 1e-9, 6) AS it_load_mw, round(lo + 1e-9, 6) AS ci_low_mw, round(hi + 1e-9, 6) AS ci_high_mw, round(gwh + 1e-7, 4) AS annual_gwh, round(gwh_low + 1e-7, 4) AS annual_gwh_low, round(gwh_high + 1e-7, 4) AS annual_gwh_high FROM c")
def tier_c_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load from floor area."""
    yearly = [F.round(F.col(c) + 1e-7, 4).alias(c) for c in ("annual_gwh", "annual_gwh_low", "annual_gwh_high")]
    return _area(spark, sf_dir).select("facility_id", *[F.round(F.col(c) + 1e-9, 6).alias(c) for c in ("it_load_mw", "ci_low_mw", "ci_high_mw")], *yearly)


_TIER_B = """fl AS (SELECT facility_id, sum(g) AS g, sum(rated) AS rated, sum(kw) AS kw FROM lk JOIN inv USING (sid) GROUP BY 1 HAVING sum(g) > 0),
b AS (SELECT facility_id, 'B_generator' AS method, (kw + (g - rated) * 2100) / 1000 / 1.30 * 0.85 AS mw, least((kw + (g - rated) * 885) / 1000 / 2.00 * 0.85, (kw + (g - rated) * 2100) / 1000 / 1.30 * 0.85) AS lo,
      greatest((kw + (g - rated) * 2190) / 1000 / 1.10 * 0.85, (kw + (g - rated) * 2100) / 1000 / 1.30 * 0.85) AS hi, (kw + (g - rated) * 2100) / 1000 / 1.30 * 0.85 * pm * 0.70 * 8760 / 1000 AS gwh FROM pf JOIN fl USING (facility_id))"""


@query(f"WITH {_PRIORS}, {_FAC}, {_PRIOR}, {_FLEET}, {_TIER_B} SELECT facility_id, round(mw + 1e-9, 6) AS it_load_mw, round(lo + 1e-9, 6) AS ci_low_mw, round(hi + 1e-9, 6) AS ci_high_mw, round(gwh + 1e-7, 4) AS annual_gwh FROM b")
def tier_b_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load from generator fleets."""
    links, inventory = _inventory(spark, sf_dir)
    out = power.fleet_estimates(table(spark, sf_dir, "facilities"), links, inventory)
    return out.select("facility_id", *[F.round(F.col(c) + 1e-9, 6).alias(c) for c in ("it_load_mw", "ci_low_mw", "ci_high_mw")], F.round(F.col("annual_gwh") + 1e-7, 4).alias("annual_gwh"))


_CITED = "a AS (SELECT facility_id, 'A_attested' AS method, mw * 0.85 AS mw, mw * 0.85 * 0.85 AS lo, mw * 0.85 * 1.15 AS hi, mw * 0.85 * pm * 0.70 * 8760 / 1000 AS gwh FROM pf JOIN (SELECT facility_id, best_power_mw AS mw FROM facilities WHERE best_power_mw > 0 AND NOT isnan(best_power_mw) AND n_sources >= 3) USING (facility_id))"


def _cited(spark: SparkSession, sf_dir: str) -> DataFrame:
    cited = _facilities(spark, sf_dir).where((F.col("best_power_mw") > 0) & (F.col("n_sources") >= 3))
    return power.attested_estimates(cited.select("facility_id", F.col("best_power_mw").alias("stated_value_mw"), F.lit("critical_load").alias("basis"), F.lit("https://filing.example/").alias("source_url"), "facility_class", "year_built"))


def _estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    links, inventory = _inventory(spark, sf_dir)
    parts = _cited(spark, sf_dir), power.fleet_estimates(table(spark, sf_dir, "facilities"), links, inventory), _area(spark, sf_dir)
    return parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)


_ALL_EST = f"WITH {_PRIORS}, {_FAC}, {_PRIOR}, {_FLEET}, {_TIER_B}, {_AREA}, {_CITED}, e AS (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * EXCLUDE (gwh_low, gwh_high) FROM c)"


@query(f"{_ALL_EST} SELECT facility_id, round(arg_min(mw, method) + 1e-9, 6) AS best_power_mw, round(arg_min(lo, method) + 1e-9, 6) AS power_ci_low_mw, min(method) AS power_tier, count(DISTINCT method) AS n_power_methods FROM e GROUP BY 1")
def tier_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best estimate of every facility and how many methods it has."""
    best = power.best_estimates(_estimates(spark, sf_dir))
    return best.select("facility_id", F.round(F.col("best_power_mw") + 1e-9, 6).alias("best_power_mw"), F.round(F.col("power_ci_low_mw") + 1e-9, 6).alias("power_ci_low_mw"), "power_tier", "n_power_methods")


@query(f"""{_ALL_EST}, w AS (SELECT facility_id, max(mw) FILTER (method = 'A_attested') AS a, max(mw) FILTER (method = 'B_generator') AS b, max(mw) FILTER (method = 'C_area') AS c FROM e GROUP BY 1),
r AS (SELECT 'A_attested vs B_generator' AS pair, CASE WHEN a > 0 THEN b / a END AS x FROM w UNION ALL SELECT 'A_attested vs C_area', CASE WHEN a > 0 THEN c / a END FROM w UNION ALL SELECT 'B_generator vs C_area', CASE WHEN b > 0 THEN c / b END FROM w)
SELECT pair, count(*) AS n_facilities, round(quantile_cont(x, 0.5), 6) AS median_ratio, round(quantile_cont(x, 0.25), 6) AS p25_ratio, round(quantile_cont(x, 0.75), 6) AS p75_ratio FROM r WHERE x IS NOT NULL GROUP BY 1""")
def tier_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles of the ratios between tiers."""
    return power.tier_agreement(_estimates(spark, sf_dir)).select("pair", "n_facilities", *[F.round(c, 6).alias(c) for c in ("median_ratio", "p25_ratio", "p75_ratio")])


_POWER = "CASE WHEN isnan(best_power_mw) THEN NULL ELSE best_power_mw END"
_GWH = "CASE WHEN isnan(est_annual_gwh) THEN NULL ELSE est_annual_gwh END"


@query(f"""
WITH t AS (SELECT coalesce(sum({_POWER}), 0) AS mw, coalesce(sum({_GWH}), 0) / 1000 AS twh, count({_POWER}) AS n FROM facilities)
SELECT round(mw, 1) AS bottom_up_it_load_mw, round(twh, 2) AS bottom_up_annual_twh, twh BETWEEN 104.76 AND 288.36 AS within_anchor_range, CASE WHEN twh > 0 THEN round(174.6 / twh, 3) END AS implied_calibration_factor, n AS n_facilities_with_power FROM t
""")
def reconcile_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals against a national anchor."""
    report = power.reconcile(_facilities(spark, sf_dir), 174.6, 104.76, 288.36)
    return report.select("bottom_up_it_load_mw", "bottom_up_annual_twh", "within_anchor_range", "implied_calibration_factor", "n_facilities_with_power")


@query(f"""
WITH t AS (SELECT coalesce(sum({_GWH}), 0) / 1000 AS twh FROM facilities), x AS (SELECT CASE WHEN NOT (twh BETWEEN 500 AND 900) THEN round(700.0 / twh, 3) END AS k FROM t)
SELECT facility_id, round(CASE WHEN k IS NOT NULL AND power_tier IS DISTINCT FROM 'A_attested' THEN ({_POWER}) * k ELSE {_POWER} END, 5) AS best_power_mw, k IS NOT NULL AS calibration_applied FROM facilities, x
""")
def calibrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: modelled loads scaled by the implied factor, cited ones kept, rows without a tier scaled too."""
    rows = _facilities(spark, sf_dir)
    out = power.calibrate(rows, power.reconcile(rows, 700.0, 500.0, 900.0), enabled=True)
    return out.select("facility_id", F.round("best_power_mw", 5).alias("best_power_mw"), "calibration_applied")


@query(f"""
WITH s AS (SELECT * FROM {_values([r[:2] + r[3:6] for r in v.JURISDICTIONS])} AS s(state, state_name, anchor, low, high)),
f AS (SELECT state, count(*) AS facilities, count(CASE WHEN isnan(footprint_sqft) THEN NULL ELSE footprint_sqft END) AS with_footprint, count({_POWER}) AS with_power_estimate, count(*) FILTER (n_sources > 1) AS multi_source,
      coalesce(sum({_POWER}), 0) AS mw, coalesce(sum({_GWH}), 0) / 1000 AS twh, count(*) FILTER (power_tier = 'B_generator') AS tier_b_facilities FROM facilities GROUP BY 1)
SELECT state, state_name, facilities, with_footprint, with_power_estimate, multi_source, round(mw, 1) AS sum_it_load_mw, round(twh, 2) AS sum_annual_twh, tier_b_facilities, twh BETWEEN low AND high AS within_anchor_range FROM f JOIN s USING (state)
""")
def summary_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and totals of every jurisdiction against its anchor."""
    out = analytics.summary_by_state(_facilities(spark, sf_dir), dims.jurisdictions(spark))
    return out.select("state", "state_name", "facilities", "with_footprint", "with_power_estimate", "multi_source", "sum_it_load_mw", "sum_annual_twh", "tier_b_facilities", "within_anchor_range")


# --- figures -----------------------------------------------------------------------------------


@query(f"""
WITH f AS (SELECT coalesce(nullif(trim(operator), ''), 'Operator not established') AS operator, {_POWER} AS mw, {_NAN('power_ci_low_mw')} AS lo, power_tier FROM facilities),
b AS (SELECT operator, coalesce(sum(mw) FILTER (power_tier = 'B_generator'), 0) AS tb, coalesce(sum(mw) FILTER (power_tier = 'C_area'), 0) AS tc, sum(mw) AS total, sum(lo) AS lo, count(mw) AS estimated_sites, count(*) AS total_sites FROM f GROUP BY 1 HAVING count(mw) > 0)
SELECT operator, round(tb, 6) AS "B_generator", round(tc, 6) AS "C_area", round(total, 6) AS total_mw, round(greatest(0, total - lo), 6) AS whisker_low, estimated_sites, total_sites FROM b ORDER BY total DESC, operator LIMIT 16
""")
def top_operators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sixteen operators with most load, by tier."""
    out = analytics.top_operators(_facilities(spark, sf_dir))
    return out.select("operator", *[F.round(c, 6).alias(c) for c in ("B_generator", "C_area", "total_mw", "whisker_low")], "estimated_sites", "total_sites")


@query(f"SELECT utility, round(coalesce(sum({_POWER}), 0), 6) AS total_mw, count(*) AS sites FROM facilities WHERE utility IS NOT NULL GROUP BY 1 ORDER BY coalesce(sum({_POWER}), 0) DESC, utility LIMIT 12")
def load_by_utility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twelve utilities with most load."""
    return analytics.load_by(_facilities(spark, sf_dir), "utility").select("utility", F.round("total_mw", 6).alias("total_mw"), "sites")


@query(f"""
SELECT facility_id, row_number() OVER w AS rank, round(sum(mw) OVER (ORDER BY mw DESC, facility_id ROWS UNBOUNDED PRECEDING) / sum(mw) OVER (), 9) AS cumulative_share FROM (SELECT facility_id, {_POWER} AS mw FROM facilities) WHERE mw IS NOT NULL WINDOW w AS (ORDER BY mw DESC, facility_id)
""")
def rank_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks and cumulative shares of load, range-partitioned."""
    return analytics.running_share(_facilities(spark, sf_dir).select("facility_id", "best_power_mw"), "best_power_mw", "facility_id").select("facility_id", "rank", F.round("cumulative_share", 9).alias("cumulative_share"))


@query(f"SELECT power_tier, count(*) AS sites, round(coalesce(sum({_POWER}), 0), 6) AS total_mw FROM facilities GROUP BY 1")
def evidence_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites and load by tier."""
    return analytics.evidence_composition(_facilities(spark, sf_dir)).select("power_tier", "sites", F.round("total_mw", 6).alias("total_mw"))


@query(f"""
WITH f AS (SELECT *, {_NAN('lat')} AS la, {_NAN('lon')} AS lo, {_NAN('footprint_sqft')} AS ft, {_POWER} AS mw FROM facilities),
c AS (SELECT count(*) AS n, count(*) FILTER (la IS NOT NULL AND lo IS NOT NULL) AS located, count(*) FILTER (operator_confidence IN ('alias', 'alias_token')) AS operator_resolved, count(utility) AS utility_assigned, count(ft) AS footprint_measured,
  count(mw) AS any_estimate, count(*) FILTER (power_tier = 'B_generator') AS generator_evidence, count(*) FILTER (power_tier = 'A_attested') AS cited_figure, count(*) FILTER (n_sources > 1) AS several_sources, count(*) FILTER (n_power_methods > 1) AS several_methods, count(year_built) AS year_known FROM f)
SELECT item, known, round(known / n, 9) AS share FROM (UNPIVOT c ON located, operator_resolved, utility_assigned, footprint_measured, any_estimate, generator_evidence, cited_figure, several_sources, several_methods, year_known INTO NAME item VALUE known)
""")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten facts and how often they are known."""
    return analytics.completeness(_facilities(spark, sf_dir)).select("item", "known", F.round("share", 9).alias("share"))


@query(f"""
WITH f AS (SELECT {_POWER} AS x, pdb_net_count AS y FROM facilities), g AS (SELECT * FROM f WHERE x IS NOT NULL AND y IS NOT NULL),
r AS (SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM g)
SELECT count(*) AS n, round(corr(rx, ry), 9) AS rho FROM r
""")
def interconnection_vs_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank correlation of load and networks."""
    return analytics.spearman(_facilities(spark, sf_dir), "best_power_mw", "pdb_net_count").select("n", F.round("rho", 9).alias("rho"))


_HIST = """h AS (SELECT id, TRY_CAST(substr(min(created), 1, 4) AS INT) AS created_year, year(min(snapshot_date)) AS seen_year FROM peeringdb_fac GROUP BY 1)"""


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "peeringdb_fac").groupBy("id").agg(F.substring(F.min("created"), 1, 4).try_cast("int").alias("created_year"), F.year(F.min("snapshot_date")).alias("seen_year"))


@query(f"""
WITH {_HIST}, y AS (SELECT unnest(generate_series(least(min(created_year), min(seen_year)), greatest(max(created_year), max(seen_year)))) AS year FROM h)
SELECT CAST(y.year AS INT) AS year, (SELECT count(*) FROM h WHERE created_year <= y.year) AS created_year, (SELECT count(*) FROM h WHERE seen_year <= y.year) AS seen_year FROM y
""")
def cumulative_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry entries created and first seen up to each year."""
    return analytics.cumulative_by_year(_history(spark, sf_dir), ("created_year", "seen_year"))


@query(f"""
WITH {_HIST}, e AS (SELECT id, created_year, seen_year, id % 97 + created_year AS noise, seen_year - created_year AS err FROM h WHERE created_year IS NOT NULL), w AS (SELECT arg_max(id, abs(err) * 1000000000 + id) AS worst FROM e),
m AS (SELECT err, count(*) AS c FROM e GROUP BY 1)
SELECT (SELECT count(*) FROM e) AS n, (SELECT quantile_cont(err, 0.5) FROM e) AS median_error, (SELECT min(err) FROM m WHERE c = (SELECT max(c) FROM m)) AS modal_error, worst, (SELECT round(corr(created_year, noise), 9) FROM e WHERE id <> worst) AS corr_without_worst FROM w
""")
def error_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median, mode, worst case, and the correlation without it."""
    rows = _history(spark, sf_dir).where(F.col("created_year").isNotNull()).withColumn("noise", F.col("id") % 97 + F.col("created_year")).withColumn("err", (F.col("seen_year") - F.col("created_year")).cast("bigint"))
    return analytics.error_profile(rows, "err", "created_year", "noise", "id").select("n", "median_error", "modal_error", "worst", F.round("corr_without_worst", 9).alias("corr_without_worst"))


@query(f"""
WITH f AS (SELECT *, {_NAN('lat')} AS la, {_NAN('lon')} AS lo, {_POWER} AS mw FROM facilities)
SELECT 'position_present' AS rule, count(*) FILTER (la IS NULL OR lo IS NULL) AS violations FROM f
UNION ALL SELECT 'power_range', count(*) FILTER (mw NOT BETWEEN 0 AND 2000) FROM f
UNION ALL SELECT 'sources_counted', count(*) FILTER (NOT coalesce(n_sources >= 1, false)) FROM f
UNION ALL SELECT 'facility_id_unique', count(*) - count(DISTINCT facility_id) FROM f
UNION ALL SELECT 'inside_a_jurisdiction', count(*) FILTER (NOT coalesce({_INSIDE.replace('lon BETWEEN', 'lo BETWEEN').replace('lat BETWEEN', 'la BETWEEN')}, false)) FROM f
""")
def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: violations of the contract on published facilities."""
    from siteweave.plans.build import ALL_BOXES as boxes

    found = violations(_facilities(spark, sf_dir), facility_rules(lookups.in_any_box(F.col("lat"), F.col("lon"), boxes)), unique="facility_id")
    return found.where(F.col("rule").isin("position_present", "power_range", "sources_counted", "facility_id_unique", "inside_a_jurisdiction"))


_BROKEN = lambda rule, ok, of: f"SELECT '{rule}' AS rule, count(*) FILTER (NOT coalesce({ok}, false)) AS violations FROM {of}"
_FACILITY_RULES = {
    "facility_id_present": "facility_id IS NOT NULL",
    "name_present": "name IS NOT NULL",
    "position_present": "la IS NOT NULL AND lo IS NOT NULL",
    "lat_range": "la BETWEEN -90 AND 90",
    "lon_range": "lo BETWEEN -180 AND 180",
    "inside_a_jurisdiction": _INSIDE.replace("lon BETWEEN", "lo BETWEEN").replace("lat BETWEEN", "la BETWEEN"),
    "power_range": "mw IS NULL OR mw BETWEEN 0 AND 2000",
    "tier_known": "power_tier IS NULL OR power_tier IN ('A_attested', 'B_generator', 'C_area')",
    "sources_counted": "n_sources >= 1",
    "interval_ordered": "coalesce(low <= mw + 1e-9 AND mw <= high + 1e-9, true)",
}


@query(f"""
WITH f AS (SELECT *, {_NAN('lat')} AS la, {_NAN('lon')} AS lo, {_POWER} AS mw, {_NAN('power_ci_low_mw')} AS low, {_NAN('power_ci_high_mw')} AS high FROM facilities)
{' UNION ALL '.join(_BROKEN(rule, ok, 'f') for rule, ok in _FACILITY_RULES.items())}
UNION ALL SELECT 'facility_id_unique', (SELECT count(*) FROM f) - (SELECT count(*) FROM (SELECT DISTINCT facility_id FROM f))
""")
def facility_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: violations of every rule of the contract on published facilities; contract_violations has five of them."""
    from siteweave.plans.build import ALL_BOXES as boxes

    return violations(_facilities(spark, sf_dir), facility_rules(lookups.in_any_box(F.col("lat"), F.col("lon"), boxes)), unique="facility_id")


_POWER_RULES = {
    "method_known": "method IN ('A_attested', 'B_generator', 'C_area')",
    "basis_present": "basis IS NOT NULL",
    "assumptions_present": "method IS NOT NULL",
    "load_range": "mw BETWEEN 0 AND 2000",
    "interval_ordered": "lo <= hi + 1e-9",
    "attested_has_url": "method <> 'A_attested' OR length(url) > 0",
}


@query(f"""{_ALL_EST}, p AS (SELECT *, CASE method WHEN 'A_attested' THEN 'critical_load' ELSE 'modelled' END AS basis, CASE method WHEN 'A_attested' THEN 'https://filing.example/' END AS url FROM e)
{' UNION ALL '.join(_BROKEN(rule, ok, 'p') for rule, ok in _POWER_RULES.items())}""")
def power_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2: violations of every rule of the contract on load estimates."""
    from siteweave.plans.build import explained

    return violations(explained(_estimates(spark, sf_dir)), power_rules())


@query("""
WITH f AS (SELECT facility_id, lat, lon FROM facilities WHERE lat IS NOT NULL AND lon IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lon) AND NOT (lat = 0 AND lon = 0)),
n AS (SELECT DISTINCT type || '/' || id AS k, lat, lon FROM overpass_datacenters WHERE type = 'node' AND lat IS NOT NULL AND snapshot_date = (SELECT max(snapshot_date) FROM overpass_datacenters)),
d AS (SELECT facility_id, 2 * 6371.0088 * asin(least(1, sqrt(pow(sin(radians(n.lat - f.lat) / 2), 2) + cos(radians(f.lat)) * cos(radians(n.lat)) * pow(sin(radians(n.lon - f.lon) / 2), 2)))) AS km FROM f, n)
SELECT facility_id, round(min(km), 6) AS km FROM d GROUP BY 1
""")
def nearest_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kilometres from each facility to the nearest mapped node."""
    points = table(spark, sf_dir, "facilities").select(F.col("facility_id").alias("id"), "lat", "lon")
    nodes = osm.latest_snapshot(table(spark, sf_dir, "overpass_datacenters"), "snapshot_date").where(F.col("type") == "node")
    features = nodes.select(F.concat_ws("/", "type", F.col("id").cast("string")).alias("id"), "lat", "lon").distinct()
    return evidence.nearest_km(points, features).select(F.col("id").alias("facility_id"), F.round("km", 6).alias("km"))


def _albers(lon: str, lat: str, south: float, north: float, origin: float, meridian: float) -> tuple[str, str]:
    """The equal-area conic as SQL (Snyder 1987, page 101)."""
    e2 = 0.0066943800229007876
    e = e2**0.5
    q = lambda s: f"({1 - e2!r} * (({s}) / (1 - {e2!r} * ({s}) * ({s})) - ln((1 - {e!r} * ({s})) / (1 + {e!r} * ({s}))) / {2 * e!r}))"
    sine = lambda degrees: f"sin(radians({degrees}))"
    m2 = lambda degrees: f"(pow(cos(radians({degrees})), 2) / (1 - {e2!r} * pow({sine(degrees)}, 2)))"
    n = f"(({m2(south)} - {m2(north)}) / ({q(sine(north))} - {q(sine(south))}))"
    rho = lambda at: f"(6378137.0 * sqrt({m2(south)} + {n} * {q(sine(south))} - {n} * {q(sine(at))}) / {n})"
    theta = f"({n} * radians(({lon}) - ({meridian})))"
    return f"({rho(lat)} * sin({theta}))", f"({rho(origin)} - {rho(lat)} * cos({theta}))"


_CONUS, _ALASKA = _albers("lon", "lat", 29.5, 45.5, 23.0, -96.0), _albers("lon", "lat", 55.0, 65.0, 50.0, -154.0)


def _ring_areas(source: str, key: str, zone: str) -> str:
    """CTEs from ``source`` (key, zone, shape) to ``areas`` (key, area): rings projected, outer ones less their holes."""
    return f"""
ring_text AS (SELECT {key}, {zone} AS zone, shape, unnest(regexp_extract_all(shape, '\\(+[^()]*\\)')) AS t FROM {source}),
ring AS (SELECT {key}, zone, starts_with(t, '((') AS outside, row_number() OVER () AS ring_id, list_transform(regexp_extract_all(t, '-?[0-9.]+(?:[eE][-+]?[0-9]+)?'), lambda x: CAST(x AS DOUBLE)) AS v FROM ring_text),
corner AS (SELECT {key}, zone, outside, ring_id, i, v[2 * i - 1] AS lon, v[2 * i] AS lat FROM (SELECT *, unnest(range(1, len(v) // 2 + 1)) AS i FROM ring)),
metre AS (SELECT *, CASE WHEN zone = 'AK' THEN {_ALASKA[0]} ELSE {_CONUS[0]} END AS x, CASE WHEN zone = 'AK' THEN {_ALASKA[1]} ELSE {_CONUS[1]} END AS y FROM corner),
near_corner AS (SELECT *, x - first_value(x) OVER w AS dx, y - first_value(y) OVER w AS dy FROM metre WINDOW w AS (PARTITION BY ring_id ORDER BY i)),
side AS (SELECT *, lead(dx) OVER w AS nx, lead(dy) OVER w AS ny FROM near_corner WINDOW w AS (PARTITION BY ring_id ORDER BY i)),
ring_area AS (SELECT {key}, ring_id, outside, abs(sum(coalesce(dx * ny - dy * nx, 0))) / 2 AS a FROM side GROUP BY ALL),
areas AS (SELECT {key}, sum(CASE WHEN outside THEN a ELSE -a END) AS area FROM ring_area GROUP BY 1)"""


@query(f"""
WITH f AS (SELECT facility_id, lat, lon FROM facilities),
shape AS (SELECT utility, geometry AS shape, row_number() OVER () AS s FROM (SELECT DISTINCT utility, geometry FROM utilities WHERE geometry LIKE '%(%' AND trim(coalesce(utility_name, '')) NOT IN ({", ".join("'" + n.replace("'", "''") + "'" for n in v.OVERLAY_TERRITORIES)}))),
{_ring_areas("shape", "s", "''")},
edge_ring AS (SELECT s, v FROM ring), step AS (SELECT s, v, unnest(range(1, len(v) - 2, 2)) AS i FROM edge_ring),
edge AS (SELECT s, v[i] AS x1, v[i + 1] AS y1, v[i + 2] AS x2, v[i + 3] AS y2 FROM step),
located AS (SELECT * FROM f WHERE lat IS NOT NULL AND lon IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lon) AND NOT (lat = 0 AND lon = 0)),
hit AS (SELECT s, facility_id FROM edge JOIN located ON (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 GROUP BY ALL HAVING count(*) % 2 = 1),
sized AS (SELECT utility, min(area) AS area FROM shape JOIN areas USING (s) GROUP BY 1),
found AS (SELECT facility_id, arg_min(utility, struct_pack(a := area, u := utility)) AS utility, string_agg(DISTINCT utility, ',' ORDER BY utility) AS utility_candidates FROM hit JOIN shape USING (s) JOIN sized USING (utility) GROUP BY 1)
SELECT f.facility_id, utility, utility_candidates FROM f LEFT JOIN found USING (facility_id)
""")
def serving_utility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Territories of each facility, the smallest serves."""
    territories = table(spark, sf_dir, "utilities")
    return evidence.serving_territories(table(spark, sf_dir, "facilities").select("facility_id", "lat", "lon"), territories, dims.overlays(spark))


@query(f"""
WITH shape AS (SELECT row_id, CASE WHEN upper(trim(state)) IN ('AK', 'ALASKA') THEN 'AK' ELSE '' END AS state, geometry_wkt AS shape FROM records WHERE is_building AND geometry_wkt LIKE '%(%' AND coalesce(upper(trim(state)) NOT IN ('HI', 'HAWAII'), true)),
{_ring_areas("shape", "row_id", "state")}
SELECT row_id, round(area, 3) AS footprint_sqm FROM areas WHERE area > 0
""")
def footprint_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projected area of building outlines; Hawaii's projection has its own test."""
    from siteweave.plans.build import measured

    text = F.upper(F.trim(F.coalesce("state", F.lit(""))))
    state = F.when(text.isin("AK", "ALASKA"), "AK").otherwise(text)
    rows = table(spark, sf_dir, "records").where(~text.isin("HI", "HAWAII")).select("row_id", state.alias("state"), "geometry_wkt", "is_building", F.lit(None).cast("double").alias("footprint_sqm"))
    return measured(rows).where(F.col("footprint_sqm").isNotNull()).select("row_id", F.round("footprint_sqm", 3).alias("footprint_sqm"))


@query("""
WITH w AS (SELECT doc_id, unnest(list_distinct(list_filter(string_split(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g'), ' '), lambda x: length(x) > 4))) AS word FROM documents),
n AS (SELECT facility_id, unnest(list_distinct(list_filter(string_split(regexp_replace(lower(name), '[^\\p{L}\\p{N}]+', ' ', 'g'), ' '), lambda x: length(x) > 4))) AS word FROM facilities),
c AS (SELECT doc_id, facility_id, count(*) AS overlap FROM w JOIN n USING (word) GROUP BY 1, 2)
SELECT doc_id AS filing_id, facility_id, overlap FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY overlap DESC, facility_id) AS r FROM c) WHERE r = 1
""")
def text_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each text of any length the facility whose name shares most long words with it."""
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("filing_id"), F.col("text").alias("title"))
    return evidence.by_title(table(spark, sf_dir, "facilities"), texts)


@query("""
SELECT f.facility_id, o.note FROM facilities f JOIN (VALUES ('data center', NULL, 'a'), ('campus', 'networks', 'b'), ('bldg', 'telecom', 'c')) AS o(n, op, note) ON contains(lower(f.name), o.n) AND (o.op IS NULL OR coalesce(contains(lower(f.operator), o.op), false))
""")
def phrase_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hand-entered overrides on all facilities whose name, and operator if given, contain their text."""
    overrides = spark.createDataFrame([("data center", None, "a"), ("campus", "networks", "b"), ("bldg", "telecom", "c")], "name_contains string, operator_contains string, note string")
    return evidence.by_phrase(table(spark, sf_dir, "facilities"), overrides).select("facility_id", "note")


@query("""
WITH RECURSIVE keyed AS (SELECT lower(trim(left_source)) || '|' || nullif(lower(trim(left_source_id)), '') AS a, lower(trim(right_source)) || '|' || nullif(lower(trim(right_source_id)), '') AS b, score, lower(trim(decision)) AS d FROM dedupe_review),
pair AS (SELECT least(a, b) AS i, greatest(a, b) AS j, max(score) AS score, coalesce(max(CAST(starts_with(d, 'no') AS INT)), 0) = 1 AS ban FROM keyed WHERE a IS NOT NULL AND b IS NOT NULL AND a <> b GROUP BY 1, 2),
edge AS (SELECT i, j, score FROM pair WHERE NOT ban AND score >= 0.5),
vertex AS (SELECT v, CAST(row_number() OVER (ORDER BY v) AS INT) AS id FROM (SELECT i AS v FROM edge UNION SELECT j FROM edge)),
coded AS (SELECT p.id AS i, q.id AS j, score, e.i AS vi, e.j AS vj FROM edge e JOIN vertex p ON p.v = e.i JOIN vertex q ON q.v = e.j),
lists AS (SELECT list(i ORDER BY score DESC, vi, vj) AS li, list(j ORDER BY score DESC, vi, vj) AS lj, count(*) AS n FROM coded),
bans AS (SELECT coalesce(list(struct_pack(p := p.id, q := q.id)), []) AS lb FROM pair x JOIN vertex p ON p.v = x.i JOIN vertex q ON q.v = x.j WHERE ban),
run AS (SELECT 0 AS k, list(id ORDER BY id) AS owner FROM vertex
UNION ALL SELECT k + 1, CASE WHEN a = b OR len(list_filter(lb, lambda x: (owner[x.p] = a AND owner[x.q] = b) OR (owner[x.p] = b AND owner[x.q] = a))) > 0 THEN owner ELSE list_transform(owner, lambda o: CASE WHEN o = greatest(a, b) THEN least(a, b) ELSE o END) END
FROM (SELECT k, owner, lb, owner[li[k + 1]] AS a, owner[lj[k + 1]] AS b FROM run, lists, bans WHERE k < n)),
done AS (SELECT owner FROM run ORDER BY k DESC LIMIT 1)
SELECT v.v, c.v AS cluster FROM vertex v, done JOIN vertex c ON true WHERE c.id = owner[v.id]
""")
def constrained_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2, O3: reviewed pairs merged best first, with refused pairs as cannot-link."""
    from siteweave.operators.resolve import constrained_clusters as merge
    from siteweave.storage import Scratch

    rows = table(spark, sf_dir, "dedupe_review").select(record_key(F.col("left_source"), F.col("left_source_id")).alias("a"), record_key(F.col("right_source"), F.col("right_source_id")).alias("b"), "score", key_part(F.col("decision")).alias("d"))
    rows = rows.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).select(F.least("a", "b").alias("i"), F.greatest("a", "b").alias("j"), "score", "d")
    pairs = rows.groupBy("i", "j").agg(F.max("score").alias("score"), F.max(F.col("d").rlike("^no")).alias("no"))
    bans = pairs.where(F.coalesce("no", F.lit(False)))
    edges = pairs.where(~F.coalesce("no", F.lit(False)) & (F.col("score") >= 0.5))
    return merge(edges.select("i", "j", "score"), bans.select("i", "j"), Scratch(spark, "clusters"))


@query()
def registry_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scans to records, classes, facilities and the best estimate of each, in one build."""
    from siteweave.plans.build import build

    elements = osm.latest_snapshot(table(spark, sf_dir, "overpass_datacenters"), "snapshot_date")
    registry = peeringdb.newest(osm.latest_snapshot(table(spark, sf_dir, "peeringdb_fac"), "snapshot_date"), F.col("retrieved_at"))
    units, inventory = nei.to_records(table(spark, sf_dir, "nei_units"))
    built = build(osm.to_records(elements).unionByName(peeringdb.to_records(registry)).unionByName(units), inventory, table(spark, sf_dir, "utilities"))
    return built.facilities.select("facility_id", "state", "name", "operator", "facility_class", "utility", "source_list", "n_sources", "best_power_mw", "power_tier")
