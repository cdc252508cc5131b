"""Queries of the problems on text, names, addresses and matches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.functions.keys import any_timestamp, key_part, record_key
from siteweave.llm.addresses import record_pairs, same_addresses
from siteweave.llm.components import groups
from siteweave.llm.languages import label_language, sentence_languages
from siteweave.llm.matching import MIN_CONFIDENCE, match_sources, rule_confidence
from siteweave.llm.names import link_names, words_of
from siteweave.llm.packing import CAPACITY, pack
from siteweave.llm.survivor import survivors
from siteweave.llm.tokenizer import encode_documents
from siteweave.llm.usable import STAND_INS, area_usable, text_usable, valid_deliveries
from siteweave.storage import Scratch, table

#: Sorts after every key in plain byte order, so that a facility is never the least vertex of a group with records.
FACILITY_MARK = "\U0010ffff"


def latest_decisions(review: DataFrame) -> DataFrame:
    """(a, b, decision): the latest decided row of every pair of record keys, whichever side each stands on."""
    left, right = record_key(F.col("left_source"), F.col("left_source_id")), record_key(F.col("right_source"), F.col("right_source_id"))
    rows = review.select(left.alias("l"), right.alias("r"), key_part(F.col("decision")).alias("decision"), "reviewed_at", "review_id")
    rows = rows.where(F.col("l").isNotNull() & F.col("r").isNotNull() & F.col("decision").isNotNull() & (F.col("l") != F.col("r")))
    newest = F.max_by("decision", F.struct(F.coalesce(F.col("reviewed_at").cast("timestamp"), F.lit("0001-01-01").cast("timestamp")), "review_id"))
    return rows.groupBy(F.least("l", "r").alias("a"), F.greatest("l", "r").alias("b")).agg(newest.alias("decision"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = latest_decisions(table(spark, sf_dir, "dedupe_review")).where(F.col("decision") == "match").select("a", "b")
    sources = table(spark, sf_dir, "facility_sources")
    facility = F.trim("facility_id")
    shared = sources.where(F.coalesce(facility, F.lit("")) != "").select(record_key(F.col("source"), F.col("source_id")).alias("a"), F.concat(F.lit(FACILITY_MARK), facility).alias("b"))
    labelled = groups(decided.unionByName(shared)).where(~F.col("v").startswith(FACILITY_MARK))
    sizes = labelled.groupBy("root").count().where(F.col("count") > 1).select("root")
    return labelled.join(sizes, "root", "left_semi").select(F.col("v").alias("record_key"), F.col("root").alias("group_key"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = table(spark, sf_dir, "facility_sources")
    links = sources.select(F.trim("facility_id").alias("facility_id"), key_part(F.col("source")).alias("src"), key_part(F.col("source_id")).alias("sid"))
    links = links.where((F.col("facility_id") != "") & (F.col("src") != "") & (F.col("sid") != "")).distinct()
    several = links.groupBy("facility_id").count().where(F.col("count") > 1).select("facility_id")
    wanted = ("row_id", "source", "source_id", "name", "address", "footprint_sqm", "updated_at")
    valid = valid_deliveries(table(spark, sf_dir, "records").select(*wanted))
    trust = table(spark, sf_dir, "source_trust").groupBy(key_part(F.col("source")).alias("src")).agg(F.min("trust_rank").alias("trust_rank"))
    rows = links.join(several, "facility_id", "left_semi").join(valid, ["src", "sid"]).join(trust, "src", "left").drop("source", "source_id")
    rows = rows.withColumnsRenamed({"src": "source", "sid": "source_id"})
    usable = [("name", text_usable(F.col("name"))), ("address", text_usable(F.col("address"))), ("footprint_sqm", area_usable(F.col("footprint_sqm")))]
    # The policy's last step is the source_id; the source after it only makes the order total.
    found = survivors(rows, "facility_id", usable, F.col("trust_rank"), F.col("updated_at"), ("source_id", "source"))
    return found.select("facility_id", "field", "source", "source_id")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = ("row_id", "source", "source_id", "address", "city", "state", "postcode", "updated_at")
    valid = valid_deliveries(table(spark, sf_dir, "records").select(*wanted))
    places, pairs = same_addresses(valid.withColumn("key", F.concat("src", F.lit("|"), "sid")))
    return record_pairs(places, pairs)


def _newest(rows: DataFrame, key: tuple[str, ...], order: list) -> DataFrame:
    """The latest row of every key of the latest snapshot."""
    latest = rows.agg(F.max("snapshot_date").alias("snapshot_date"))
    rows = rows.join(F.broadcast(latest), "snapshot_date")  # one row
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*key, "r.*")


def unlinked_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the latest snapshots and of the emission units without a row in the crosswalk, in one shape."""
    peering = table(spark, sf_dir, "peeringdb_fac").select("snapshot_date", "retrieved_at", "id", "org_name", "name", "address1", "city", "state", "zipcode", "latitude", "longitude", "updated")
    peering = _newest(peering, ("id",), [any_timestamp(F.col("updated")), F.col("retrieved_at"), F.xxhash64("name", "address1")])
    a = peering.select(record_key(F.lit("peeringdb"), F.col("id")).alias("key"), F.lit("peeringdb").alias("src"), "name", F.col("org_name").alias("operator"), F.col("address1").alias("address"), "city", "state", F.col("zipcode").alias("postcode"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    tag = lambda name: F.try_element_at("tags", F.lit(name))
    mapped = table(spark, sf_dir, "overpass_datacenters").select(
        "snapshot_date", "retrieved_at", "type", "id", *[tag(t).alias(n) for t, n in (("name", "name"), ("operator", "operator"), ("addr:city", "city"), ("addr:state", "state"), ("addr:postcode", "postcode"))],
        F.coalesce(tag("addr:full"), F.nullif(F.concat_ws(" ", tag("addr:housenumber"), tag("addr:street")), F.lit(""))).alias("address"),
        F.coalesce("lat", (F.col("bounds.minlat") + F.col("bounds.maxlat")) / 2).alias("lat"), F.coalesce("lon", (F.col("bounds.minlon") + F.col("bounds.maxlon")) / 2).alias("lon"),
    )
    mapped = _newest(mapped, ("type", "id"), [F.col("retrieved_at"), F.xxhash64("name", "address")])
    b = mapped.select(record_key(F.lit("osm"), F.concat_ws("/", "type", "id")).alias("key"), F.lit("osm").alias("src"), "name", "operator", "address", "city", "state", "postcode", "lat", "lon")
    text = lambda c: F.nullif(F.trim(c), F.lit(""))
    units = table(spark, sf_dir, "nei_units").groupBy(record_key(F.lit("epa_nei"), F.col("eis_facility_id")).alias("key")).agg(
        *[F.mode(text(c), True).alias(n) for c, n in (("site_name", "name"), ("company_name", "operator"), ("address", "address"), ("city", "city"), ("state", "state"), ("zip_code", "postcode"))],
        F.mode(F.col("site_latitude").try_cast("double"), True).alias("lat"), F.mode(F.col("site_longitude").try_cast("double"), True).alias("lon"),
    )
    c = units.withColumn("src", F.lit("epa_nei"))
    linked = table(spark, sf_dir, "facility_sources").select(record_key(F.col("source"), F.col("source_id")).alias("key"))
    return a.unionByName(b).unionByName(c).join(linked, "key", "left_anti")


def p5_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matched pairs with the rule that found each and its confidence from the reviewed pairs."""
    verdict = key_part(F.col("decision"))
    hit = F.when(verdict == "match", 1).when(verdict.rlike("^no"), 0)
    review = table(spark, sf_dir, "dedupe_review").select("left_name", "right_name", "left_address", "right_address", F.col("distance_m").alias("metres"), hit.alias("hit"))
    trusted = rule_confidence(review.where(F.col("hit").isNotNull())).where(F.col("confidence") >= MIN_CONFIDENCE)
    # One row per rule.
    return match_sources(unlinked_sites(spark, sf_dir)).join(F.broadcast(trusted), "rule").select(F.col("left").alias("left_key"), F.col("right").alias("right_key"), "rule", "confidence")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_matches(spark, sf_dir).select("left_key", "right_key")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where rows of one record denote several operators, the one that most rows denote, then the smaller id."""
    facilities = table(spark, sf_dir, "facilities").select(F.concat(F.lit("facility|"), F.trim("facility_id")).alias("record_key"), F.col("operator").alias("name"))
    peering = table(spark, sf_dir, "peeringdb_fac").select(record_key(F.lit("peeringdb"), F.col("id")).alias("record_key"), F.col("org_name").alias("name"))
    units = table(spark, sf_dir, "nei_units").select(record_key(F.lit("epa_nei"), F.col("eis_facility_id")).alias("record_key"), F.col("company_name").alias("name"))
    rows = facilities.unionByName(peering).unionByName(units).where(F.col("record_key").isNotNull() & F.col("name").isNotNull())
    scratch = Scratch(spark, "operators")
    # Equal names are counted and folded once, before anything else is done with them.
    counted = scratch.cut(rows.groupBy("record_key", "name").count())
    texts = scratch.cut(counted.select("name").distinct().withColumn("text", words_of(F.col("name"))).where(F.col("text") != ""))
    listed = table(spark, sf_dir, "operators").select(F.col("operator_id").alias("id"), F.col("operator_name").alias("name"))
    known = texts.join(link_names(texts, listed), "text").select("name", "id")
    linked = counted.join(known, "name").groupBy("record_key", "id").agg(F.sum("count").alias("n"))
    most = F.max(F.struct("n", (-F.col("id")).alias("nid")))
    return linked.groupBy("record_key").agg(most.alias("m")).select("record_key", (-F.col("m.nid")).alias("operator_id"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))


def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = encode_documents(table(spark, sf_dir, "documents"), counts_only=True)
    return pack(sized, "doc_id", "n_tokens", CAPACITY)


def p9_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row on the packing: items, tokens, containers, the least number possible, containers over capacity, items cut below it, tokens lost, and the fill."""
    sized = encode_documents(table(spark, sf_dir, "documents"), counts_only=True).where(F.col("n_tokens") > 0)
    placed = Scratch(spark, "fill").cut(pack(sized, "doc_id", "n_tokens", CAPACITY))
    bins = placed.groupBy("container").agg(F.sum("length").alias("held")).agg(F.count("*").alias("containers"), F.count_if(F.col("held") > CAPACITY).alias("over_capacity"))
    pieces = placed.groupBy("doc_id").agg(F.count("*").alias("pieces"), F.sum("length").alias("held"))
    items = sized.join(pieces, "doc_id", "left").agg(
        F.count("*").alias("items"), F.sum("n_tokens").alias("tokens"), F.count_if((F.col("pieces") > 1) & (F.col("n_tokens") <= CAPACITY)).alias("cut_below_capacity"), F.sum(F.col("n_tokens") - F.coalesce("held", F.lit(0))).alias("tokens_lost")
    )
    least = F.ceil(F.col("tokens") / CAPACITY).cast("bigint").alias("least_containers")
    # One row each.
    return items.crossJoin(bins).select("items", "tokens", "containers", least, "over_capacity", "cut_below_capacity", "tokens_lost", F.round(F.col("tokens") / (F.col("containers") * CAPACITY), 6).alias("fill"))


def p10_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_languages(table(spark, sf_dir, "documents"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    present = sentence_languages(documents).where("whole").groupBy("doc_id").agg(F.collect_set("lang").alias("langs"))
    labels = documents.select("doc_id", label_language(F.col("lang")).alias("label"))
    doubtful = (F.size("langs") > 1) | F.col("label").isNull() | ~F.array_contains("langs", F.col("label"))
    return present.join(labels, "doc_id").where(doubtful).select("doc_id", F.explode("langs").alias("lang")).distinct()


QUERIES = {"p1_found": p1_found, "p3_found": p3_found, "p4_found": p4_found, "p5_found": p5_found, "p5_matches": p5_matches, "p6_found": p6_found, "p8_ids": p8_ids, "p9_containers": p9_containers, "p9_fill": p9_fill, "p10_found": p10_found, "p10_segments": p10_segments}
_VALID = """v AS (SELECT * FROM (SELECT *, lower(trim(source)) AS src, lower(trim(source_id)) AS sid, row_number() OVER (PARTITION BY lower(trim(source)), lower(trim(source_id)) ORDER BY updated_at DESC, row_id DESC) AS n FROM records) WHERE n = 1)"""
_BARE = r"regexp_replace(lower({}), '^[^\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+$', '', 'g')"
_USABLE = "({b} <> '' AND {b} NOT IN (" + ", ".join(f"'{w}'" for w in STAND_INS) + "))"

SQL: dict[str, str] = {
    "p1_found": """
WITH RECURSIVE keyed AS (SELECT lower(trim(left_source)) || '|' || nullif(lower(trim(left_source_id)), '') AS l, lower(trim(right_source)) || '|' || nullif(lower(trim(right_source_id)), '') AS r, lower(trim(decision)) AS d, reviewed_at, review_id FROM dedupe_review),
latest AS (SELECT least(l, r) AS a, greatest(l, r) AS b, arg_max(d, struct_pack(t := reviewed_at, i := review_id)) AS d FROM keyed WHERE l IS NOT NULL AND r IS NOT NULL AND l <> r AND d IS NOT NULL GROUP BY 1, 2),
links AS (SELECT DISTINCT trim(facility_id) AS f, lower(trim(source)) || '|' || lower(trim(source_id)) AS k FROM facility_sources WHERE trim(facility_id) <> ''),
hub AS (SELECT f, min(k) AS h FROM links GROUP BY 1),
tie AS (SELECT a, b FROM latest WHERE d = 'match' UNION SELECT k, h FROM links JOIN hub USING (f) WHERE k <> h),
edge AS (SELECT a, b FROM tie UNION SELECT b, a FROM tie),
walk AS (SELECT a AS k, a AS seen FROM edge UNION SELECT walk.k, edge.b FROM walk JOIN edge ON edge.a = walk.seen)
SELECT k AS record_key, min(seen) AS group_key FROM walk GROUP BY 1
""",
    "p3_found": f"""
WITH {_VALID}, l AS (SELECT DISTINCT trim(facility_id) AS facility_id, lower(trim(source)) AS src, lower(trim(source_id)) AS sid FROM facility_sources),
m AS (SELECT * FROM l WHERE facility_id IN (SELECT facility_id FROM l GROUP BY 1 HAVING count(*) > 1)),
t AS (SELECT lower(trim(source)) AS src, min(trust_rank) AS rank FROM source_trust GROUP BY 1),
r AS (SELECT m.facility_id, m.src, m.sid, coalesce(t.rank, 1000000) AS rank, v.updated_at, {_BARE.format("v.name")} AS n, {_BARE.format("v.address")} AS a, v.footprint_sqm AS f FROM m JOIN v USING (src, sid) LEFT JOIN t USING (src)),
u AS (SELECT 'name' AS field, * FROM r WHERE {_USABLE.format(b="n")} UNION ALL SELECT 'address', * FROM r WHERE {_USABLE.format(b="a")} UNION ALL SELECT 'footprint_sqm', * FROM r WHERE NOT isnan(f) AND f >= 1 AND f <= 5e6 AND NOT (f = floor(f) AND (regexp_full_match(CAST(CAST(f AS BIGINT) AS VARCHAR), '9{{4,}}') OR f IN (12345, 123456, 1234567))))
SELECT facility_id, field, src AS source, sid AS source_id FROM (SELECT *, row_number() OVER (PARTITION BY facility_id, field ORDER BY rank, updated_at DESC, sid, src) AS k FROM u) WHERE k = 1
""",
}
