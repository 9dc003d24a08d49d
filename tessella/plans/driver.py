"""The operators bound to plain tables, each beside the SQL that says the same."""

from __future__ import annotations

import datetime as dt
import importlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import semantics as S
from ..functions import text as T
from ..functions import variants as V
from ..operators import flows, forms, hierarchy, linkage, rules, search
from ..scratch import fresh_path
from ..sinks import exports, ordered
from ..sources import candidates, documents
from . import captured, registry, taxonomy
from .registry import Query, query, table

# --- hierarchy -----------------------------------------------------------------


def place_edges(spark: SparkSession, d: str) -> DataFrame:
    """World, regions and nations as edges; siblings stand in key order."""
    region, nation = table(spark, d, "region"), table(spark, d, "nation")
    top = spark.createDataFrame([(None, "World", 0)], "parent string, node string, pos int")
    return (
        top.unionByName(region.select(F.lit("World").alias("parent"), F.col("r_name").alias("node"), F.col("r_regionkey").alias("pos")))
        .unionByName(nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("parent"), F.col("n_name").alias("node"), F.col("n_nationkey").alias("pos")))
    )


_TREE = """
WITH t AS (SELECT 'World' AS node, NULL AS parent, 'World' AS path, 0 AS depth, -1 AS a, -1 AS b
  UNION ALL SELECT r_name, 'World', 'World/' || r_name, 1, r_regionkey, -1 FROM region
  UNION ALL SELECT n_name, r_name, 'World/' || r_name || '/' || n_name, 2, r_regionkey, n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey)
"""


@query(_TREE + "SELECT node, parent, path, depth FROM t")
def hier_paths(spark, d):
    return hierarchy.paths(place_edges(spark, d)).select("node", "parent", F.array_join("path", "/").alias("path"), "depth")


@query(_TREE + "SELECT node, depth FROM t WHERE node NOT IN (SELECT parent FROM t WHERE parent IS NOT NULL)")
def hier_leaves(spark, d):
    return hierarchy.leaves(place_edges(spark, d)).select("node", "depth")


@query("""WITH r AS (SELECT r_regionkey, r_name, string_agg(n_name, ',' ORDER BY n_nationkey) AS s FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY ALL)
SELECT 'World' AS root, '(' || string_agg(CASE WHEN s IS NULL THEN r_name ELSE '(' || s || ')' || r_name END, ',' ORDER BY r_regionkey) || ')World;' AS newick FROM r""")
def hier_newick(spark, d):
    return hierarchy.newick(place_edges(spark, d))


@query(_TREE + "SELECT row_number() OVER (ORDER BY a, b) AS pre_order, node FROM t")
def hier_preorder(spark, d):
    return hierarchy.nodes(place_edges(spark, d)).select((F.col("order") + 1).alias("pre_order"), "node")


def order_edges(spark: SparkSession, d: str, orders: bool = True) -> DataFrame:
    """Regions, their nations, customers and orders: a tree that grows with the tables."""

    def edges(name: str, parent, node: str, pos: str) -> DataFrame:
        return table(spark, d, name).select(parent.alias("parent"), F.concat(F.lit(node), F.col(pos).cast("string")).alias("node"), F.col(pos).cast("int").alias("pos"))

    def above(kind: str, key: str):
        return F.concat(F.lit(kind), F.col(key).cast("string"))

    out = edges("region", F.lit(None).cast("string"), "R", "r_regionkey").unionByName(edges("nation", above("R", "n_regionkey"), "N", "n_nationkey")).unionByName(edges("customer", above("N", "c_nationkey"), "C", "c_custkey"))
    return out.unionByName(edges("orders", above("C", "o_custkey"), "O", "o_orderkey")) if orders else out


_ORDER_TREE = """WITH t AS (SELECT 'R' || r_regionkey AS node, 0 AS depth, r_regionkey AS r, -1 AS n, -1 AS c, -1 AS o FROM region
  UNION ALL SELECT 'N' || n_nationkey, 1, n_regionkey, n_nationkey, -1, -1 FROM nation
  UNION ALL SELECT 'C' || c_custkey, 2, n_regionkey, n_nationkey, c_custkey, -1 FROM customer JOIN nation ON c_nationkey = n_nationkey{})
"""


@query(_ORDER_TREE.format(" UNION ALL SELECT 'O' || o_orderkey, 3, n_regionkey, n_nationkey, c_custkey, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey") + """SELECT node, depth::BIGINT AS depth, row_number() OVER (ORDER BY r, n, c, o) - 1 AS "order",
CASE depth WHEN 0 THEN count(*) OVER (PARTITION BY r) WHEN 1 THEN count(*) OVER (PARTITION BY n) WHEN 2 THEN count(*) OVER (PARTITION BY c) ELSE 1 END AS size FROM t""")
def tree_places(spark, d):
    return hierarchy.places(order_edges(spark, d)).select("node", "depth", "order", "size")


@query(_ORDER_TREE.format("") + """, p AS (SELECT node, depth, r, row_number() OVER (ORDER BY r, n, c) - 1 AS pre, row_number() OVER (ORDER BY r, CASE n WHEN -1 THEN 1000000000 ELSE n END, CASE c WHEN -1 THEN 1000000000 ELSE c END) - 1 AS place,
  lag(depth) OVER (PARTITION BY r ORDER BY CASE n WHEN -1 THEN 1000000000 ELSE n END, CASE c WHEN -1 THEN 1000000000 ELSE c END) AS before FROM t)
SELECT min(pre) OVER (PARTITION BY r) AS root, place, CASE WHEN before IS NULL THEN '' WHEN depth < before THEN ')' ELSE ',' END || repeat('(', greatest(depth - coalesce(before, 0), 0)) || node || CASE depth WHEN 0 THEN ';' ELSE '' END AS piece FROM p""")
def tree_text(spark, d):
    return hierarchy.newick_pieces(order_edges(spark, d, orders=False), small=500)


@query("""SELECT 'tree' AS "check", 'error' AS severity, 'C' || c_custkey AS file, 'node ''C' || c_custkey || ''' is not below any root' AS message FROM customer WHERE c_nationkey % 5 = 0
UNION ALL SELECT 'tree', 'error', 'N' || n_nationkey, 'node ''N' || n_nationkey || ''' is not below any root' FROM nation WHERE n_nationkey % 5 = 0""")
def tree_cycles(spark, d):
    """Every fifth nation is put below its last customer, or below an unknown place if it has none."""
    last = table(spark, d, "customer").groupBy("c_nationkey").agg(F.max("c_custkey").alias("last"))
    moved = table(spark, d, "nation").where("n_nationkey % 5 = 0").join(last, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    moved = moved.select(F.coalesce(F.concat(F.lit("C"), F.col("last").cast("string")), F.lit("?")).alias("parent"), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("node"), F.lit(0).alias("pos"))
    edges = order_edges(spark, d, orders=False)
    return hierarchy.cycle_findings(edges.join(moved.select("node"), "node", "left_anti").unionByName(moved), "tree", small=100)


@query(_TREE + "SELECT s_suppkey, coalesce(path, '') AS path FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN t ON n_name = node")
def lookup_path_left(spark, d):
    s = table(spark, d, "supplier").join(table(spark, d, "nation").select("n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return hierarchy.with_path(s, "n_name", place_edges(spark, d)).select("s_suppkey", F.array_join("taxonomy", "/").alias("path"))


# --- rules ---------------------------------------------------------------------


@query("SELECT 'label' AS \"check\", 'error' AS severity, doc_id::VARCHAR AS file, 'document ' || doc_id || ' has no label' AS message FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def fk_anti(spark, d):
    return rules.foreign_key_findings(
        table(spark, d, "documents").select("doc_id"), {"doc_id": "doc_id"}, table(spark, d, "labels"), "label", F.col("doc_id"), F.format_string("document %s has no label", F.col("doc_id").cast("string"))
    )


@query("SELECT count(*) AS n FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey) OR NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)")
def fk_clean(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    lost = [rules.foreign_key_findings(lines, {a: b}, table(spark, d, t), a, F.col(a), F.lit("lost")) for a, b, t in (("l_orderkey", "o_orderkey", "orders"), ("l_partkey", "p_partkey", "part"))]
    return rules.gather(*lost).agg(F.count("*").alias("n"))


@query("""SELECT n_name FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_acctbal < -900) AND n_nationkey NOT IN (0, 1, 2)""")
def coverage_anti(spark, d):
    nation, customer = table(spark, d, "nation"), table(spark, d, "customer")
    exempt = spark.createDataFrame([(0,), (1,), (2,)], "value int")
    low = customer.where("c_acctbal < -900").select(F.col("c_nationkey").alias("value"))
    return rules.uncovered(nation, "n_nationkey", exempt, low).select("n_name")


@query("""SELECT 'event type' AS "check", 'error' AS severity, event_id::VARCHAR AS file, 'invalid type ' || event_type AS message FROM events WHERE event_type NOT IN ('click', 'view') AND event_type <> ''
UNION ALL SELECT 'segment', 'warning', c_custkey::VARCHAR, 'invalid segment ' || c_mktsegment FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY') AND c_mktsegment <> ''""")
def vocab_check(spark, d):
    e = rules.in_list("event type", "event_type", ["click", "view"], F.concat(F.lit("invalid type "), "event_type"))
    allowed = spark.createDataFrame([("BUILDING",), ("MACHINERY",)], "value string")
    c = rules.vocabulary_findings(table(spark, d, "customer"), "c_mktsegment", allowed, "segment", F.col("c_custkey"), F.concat(F.lit("invalid segment "), "c_mktsegment"), rules.WARNING)
    return rules.row_findings(table(spark, d, "events"), [e], F.col("event_id")).unionByName(c)


@query("""SELECT 'ship date' AS "check", 'error' AS severity, l_orderkey::VARCHAR AS file, 'line ' || l_linenumber || ' shipped before its order' AS message
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate""")
def range_lookup(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return rules.range_findings(
        lines, table(spark, d, "orders").select("o_orderkey", "o_orderdate"), {"l_orderkey": "o_orderkey"}, F.col("l_shipdate") < F.col("o_orderdate"),
        "ship date", F.col("l_orderkey"), F.format_string("line %s shipped before its order", F.col("l_linenumber").cast("string")),
    )


@query("""SELECT 'balance' AS "check", 'error' AS severity, c_custkey::VARCHAR AS file, 'balance must be positive' AS message FROM customer WHERE c_acctbal <= 0
UNION ALL SELECT 'segment', 'error', c_custkey::VARCHAR, 'missing segment' FROM customer WHERE c_mktsegment IS NULL OR c_mktsegment = ''""")
def positive_check(spark, d):
    r = [rules.positive("balance", "c_acctbal", F.lit("balance must be positive")), *rules.required("segment", {"c_mktsegment": "string"}, lambda f: F.lit("missing segment"))]
    return rules.row_findings(table(spark, d, "customer"), r, F.col("c_custkey"))


@query("SELECT l_orderkey, l_linenumber, count(*) - 1 AS repeats FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def unique_check(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    key = F.concat_ws(":", "l_orderkey", "l_linenumber")
    found = rules.uniqueness_findings(lines, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"], "line", key, F.lit("repeated"))
    n = found.groupBy("file").agg(F.count("*").alias("repeats"))
    return n.select(F.split_part("file", F.lit(":"), F.lit(1)).cast("bigint").alias("l_orderkey"), F.split_part("file", F.lit(":"), F.lit(2)).cast("int").alias("l_linenumber"), "repeats")


@query("""SELECT 'one answer' AS "check", 'error' AS severity, conv_id::VARCHAR AS file,
CASE WHEN count(*) FILTER (role = 'assistant') = 0 THEN 'no answer' ELSE 'answers: ' || count(*) FILTER (role = 'assistant') END AS message
FROM conversations GROUP BY conv_id HAVING count(*) FILTER (role = 'assistant') <> 1""")
def cardinality_check(spark, d):
    return rules.cardinality_findings(
        table(spark, d, "conversations"), ["conv_id"], F.col("role") == "assistant", "one answer", F.col("conv_id"), F.lit("no answer"), F.concat(F.lit("answers: "), F.col("n").cast("string"))
    )


@query("""WITH f AS (SELECT 'label' AS c, count(*) AS e, 0 AS w FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT 'segment', 0, count(*) FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
UNION ALL SELECT 'balance', count(*), 0 FROM customer WHERE c_acctbal <= 0 UNION ALL SELECT 'part of a line', 0, 0)
SELECT CASE c WHEN 'label' THEN 0 WHEN 'segment' THEN 1 WHEN 'balance' THEN 2 ELSE 3 END::INTEGER AS pos, c AS "check", e::BIGINT AS errors, w::BIGINT AS warnings FROM f""")
def check_summary(spark, d):
    balance = rules.positive("balance", "c_acctbal", F.lit(""))
    found = rules.gather(fk_anti(spark, d), vocab_check(spark, d).where("check = 'segment'"), rules.row_findings(table(spark, d, "customer"), [balance], F.col("c_custkey")))
    return rules.summary(found, ["label", "segment", "balance", "part of a line"])


@query("SELECT (SELECT count(*) FROM customer WHERE c_acctbal <= 0) AS errors, (SELECT count(*) FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')) AS warnings")
def check_totals(spark, d):
    balance = rules.positive("balance", "c_acctbal", F.lit(""))
    return rules.totals(rules.gather(vocab_check(spark, d).where("check = 'segment'"), rules.row_findings(table(spark, d, "customer"), [balance], F.col("c_custkey"))))


@query(taxonomy.FINDINGS_SQL)
def taxonomy_checks(spark, d):
    return taxonomy.findings(spark, d, place_edges(spark, d))


@query(taxonomy.REFERENCES_SQL)
def taxonomy_references(spark, d):
    return taxonomy.references(spark, d, place_edges(spark, d))


@query(taxonomy.PREFILLED_SQL)
def taxonomy_prefilled(spark, d):
    return taxonomy.prefilled(spark, d, place_edges(spark, d))


# --- distinct, first, lookup -----------------------------------------------------


@query("SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY text")
def first_wins_dedup(spark, d):
    docs = table(spark, d, "documents").select(F.xxhash64("text").alias("h"), F.md5(F.col("text").cast("binary")).alias("m"), "doc_id")
    first = linkage.first_wins(docs, ["h", "m"], ["doc_id"])
    n = docs.groupBy("h", "m").agg(F.count("*").alias("copies"))
    return first.join(n, (first["h"] == n["h"]) & first["m"].eqNullSafe(n["m"])).select("doc_id", "copies")


@query("SELECT c_nationkey, arg_max(c_name, c_custkey) AS c_name FROM customer GROUP BY c_nationkey")
def last_wins_key(spark, d):
    return linkage.last_wins(table(spark, d, "customer").select("c_nationkey", "c_name", "c_custkey"), ["c_nationkey"], "c_custkey").select("c_nationkey", "c_name")


@query("SELECT n_name AS stage FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA' ORDER BY n_name")
def stage_for_period(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return documents.stages_of(n.select(F.col("n_name").alias("stage"), F.col("r_name").alias("period")), "ASIA")


@query("SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'ring') ORDER BY p_partkey LIMIT 50")
def search_top50(spark, d):
    return documents.search_names(table(spark, d, "part").select("p_partkey", "p_name"), "p_name", "Ring", "p_partkey")


@query("""SELECT * FROM (SELECT 'ring' AS text, p_partkey AS key, p_name AS name FROM part WHERE contains(lower(p_name), 'ring') ORDER BY p_partkey LIMIT 50)
UNION ALL SELECT * FROM (SELECT 'ME', p_partkey, p_name FROM part WHERE contains(lower(p_name), 'me') ORDER BY p_partkey LIMIT 50) UNION ALL SELECT * FROM (SELECT 'spring r', p_partkey, p_name FROM part WHERE contains(lower(p_name), 'spring r') ORDER BY p_partkey LIMIT 50)""")
def search_indexed(spark, d):
    """Three searches in one table of grams."""
    path = fresh_path(spark, "grams")
    search.build_index(table(spark, d, "part"), "p_name", "p_partkey", path)
    hits = [search.search(spark, path, text).select(F.lit(text).alias("text"), "key", "name") for text in ("ring", "ME", "spring r")]
    return hits[0].unionByName(hits[1]).unionByName(hits[2])


@query("""SELECT doc_id, CASE WHEN contains(lower(text), 'thing') THEN 'thing' WHEN contains(lower(text), 'tion') THEN 'tion' WHEN contains(lower(text), 'der ') THEN 'der' END AS term FROM documents""")
def substring_first_match(spark, d):
    terms = [("thing", "thing"), ("tion", "tion"), ("der ", "der")]
    return table(spark, d, "documents").select("doc_id", linkage.first_match(F.col("text"), terms).alias("term"))


@query("""SELECT c_custkey, first(n_name ORDER BY n_nationkey) AS n_name FROM customer LEFT JOIN nation ON contains(lower(c_name || ' ' || c_mktsegment), lower(left(n_name, 2))) GROUP BY c_custkey""")
def substring_join(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.concat_ws(" ", "c_name", "c_mktsegment").alias("text"))
    terms = table(spark, d, "nation").select(F.left("n_name", F.lit(2)).alias("term"), F.col("n_name").alias("value"), F.col("n_nationkey").alias("pos"))
    return linkage.first_match_join(c, "text", terms, "n_name").select("c_custkey", "n_name")


@query("SELECT c_custkey, n_name AS matched FROM customer LEFT JOIN nation ON lower(n_name) = lower('nation_' || c_nationkey)")
def match_name(spark, d):
    names = table(spark, d, "nation").select(F.col("n_name").alias("value"), F.col("n_nationkey").alias("pos"))
    c = table(spark, d, "customer").select("c_custkey", F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("n"))
    return linkage.match_name(c, "n", names).select("c_custkey", "matched")


@query("""SELECT doc_id, CASE WHEN contains(lower(text), 'heon') OR contains(lower(text), 'thea') THEN 'a' WHEN contains(lower(text), 'und') OR contains(lower(text), 'der') THEN 'b' WHEN contains(lower(text), 'que') THEN 'c' END AS kind FROM documents""")
def keyword_case(spark, d):
    kinds = (("a", ("heon", "thea")), ("b", ("und", "der")), ("c", ("que",)))
    return table(spark, d, "documents").select("doc_id", T.keyword_case(F.col("text"), kinds).alias("kind"))


@query(r"""SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '&[^;]+;', '', 'g'), e' \n\t\r') AS text FROM pages""")
def strip_tags(spark, d):
    return table(spark, d, "pages").select("page_id", T.strip_tags(F.col("html")).alias("text"))


@query(r"""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace('{{box|' || page_id || '}} [[a|b]] [[c]] <ref name="x"/>d<REF n>' || page_id || '</REF> e ' || html, '(?i)<ref[^>]*/>', '', 'g'), '(?i)<ref[^>]*>[\s\S]*?</ref>', '', 'g'), '\{\{[^}]*\}\}', '', 'g'), '\[\[(?:[^|\]]*\|)?([^\]]*)\]\]', '\1', 'g'), '<[^>]+>', '', 'g'), '''{2,3}', '', 'g'), '\s+', ' ', 'g')) AS text FROM pages""")
def strip_markup(spark, d):
    page = F.col("page_id").cast("string")
    marked = F.concat(F.lit("{{box|"), page, F.lit('}} [[a|b]] [[c]] <ref name="x"/>d<REF n>'), page, F.lit("</REF> '''e''' "), F.col("html"))
    return table(spark, d, "pages").select("page_id", T.strip_markup(marked).alias("text"))


@query("""SELECT DISTINCT word FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part UNION ALL SELECT n_name FROM nation UNION ALL SELECT r_name FROM region
UNION ALL SELECT unnest(string_split(p_type, ' ')) FROM part UNION ALL SELECT unnest(['clade', 'genus'])) WHERE word <> ''""")
def dictionary(spark, d):
    part = table(spark, d, "part")
    words = [part.select(F.explode(F.split(c, r"(?U)\s+")).alias("word")) for c in ("p_name", "p_type")]
    words += [table(spark, d, "nation").select("n_name"), table(spark, d, "region").select("r_name"), spark.createDataFrame([("clade",), ("genus",)], "word string")]
    return exports.distinct_words(words)


@query("""SELECT c_custkey, 'balance' AS header, CASE WHEN c_custkey % 3 = 0 THEN 'a' WHEN c_custkey % 2 = 0 THEN 'b' ELSE 'c' END AS value FROM customer""")
def priority_merge(spark, d):
    c = table(spark, d, "customer")
    parts = [c.where(f"c_custkey % {m} = 0").select("c_custkey", F.lit("balance").alias("header"), F.lit(v).alias("value")) for m, v in ((3, "a"), (2, "b"), (1, "c"))]
    return linkage.priority_merge(parts, ["c_custkey", "header"])


@query("""SELECT c_custkey, 'c_mktsegment' AS header, c_mktsegment AS old, 'MOVED' AS new FROM customer WHERE c_custkey % 10 = 0 AND c_mktsegment <> 'MOVED'
UNION ALL SELECT c_custkey, 'c_name', c_name, NULL FROM customer WHERE c_custkey % 7 = 0 AND c_name IS NOT NULL""")
def update_diff(spark, d):
    old = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    new = old.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 10 == 0, "MOVED").otherwise(F.col("c_mktsegment"))).withColumn("c_name", F.when(F.col("c_custkey") % 7 != 0, F.col("c_name")))
    return linkage.changed(old, new, ["c_custkey"], ["c_name", "c_mktsegment"])


@query(r"""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '@incollection{' ELSE '@article{' END || o_orderkey || e',\n  author = {Clerk},\n  year = {' || year(o_orderdate) || e'},\n'
|| CASE WHEN o_orderstatus = 'F' THEN '  booktitle = {' ELSE '  journal = {' END || o_orderpriority || e'}\n}\n' AS entry FROM orders""")
def format_entry(spark, d):
    given = {"id": F.col("o_orderkey"), "authors": F.lit("Clerk"), "year": F.year("o_orderdate"), "title": F.lit("")}
    given |= {"journal": F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")), "book": F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))}
    none = {c: F.lit(None).cast("string") for c, _ in exports.ENTRY if c not in given}
    return table(spark, d, "orders").select("o_orderkey", *[(v if n == "year" else v.cast("string")).alias(n) for n, v in (given | none).items()]).select("o_orderkey", exports.bibtex_entry().alias("entry"))


@query("""SELECT p_partkey::VARCHAR AS subject, 'Q' || p_partkey AS qid, p_brand || ' ' || p_partkey % 7 AS type_species, CASE WHEN p_partkey % 5 > 0 THEN p_type END AS diet, NULL::VARCHAR AS parent_taxon,
CASE WHEN p_partkey % 3 > 0 THEN (p_size * 1000)::VARCHAR END AS mass FROM part""")
def entity_fields(spark, d):
    part = table(spark, d, "part")
    brand = F.concat("p_brand", F.lit(" "), (F.col("p_partkey") % 7).cast("string"))
    claims = F.format_string(
        '{"P427":[{"mainsnak":{"snaktype":"value","datavalue":{"value":{"id":"b%s"}}}}],"P186":[{"mainsnak":{"snaktype":"%s","datavalue":{"value":{"id":"t%s"}}}}],'
        '"P171":[{"mainsnak":{"snaktype":"value","datavalue":{"value":{"id":"none"}}}}],"P2067":[{"mainsnak":{"snaktype":"%s","datavalue":{"value":{"amount":"+%s","unit":"e/Q11570"}}}}]}',
        brand, F.when(F.col("p_partkey") % 5 > 0, "value").otherwise("novalue"), "p_type", F.when(F.col("p_partkey") % 3 > 0, "value").otherwise("somevalue"), F.col("p_size").cast("string"),
    )
    labels = part.select(F.concat(F.lit("b"), brand).alias("qid"), brand.alias("label")).union(part.select(F.concat(F.lit("t"), "p_type"), "p_type")).distinct()
    key = F.col("p_partkey").cast("string")
    return candidates.entity_fields(part.select(key.alias("subject"), F.concat(F.lit("Q"), key).alias("qid"), claims.alias("claims")), labels)


@query(captured.FOUND_SQL)
def captured_candidates(spark, d):
    return captured.found(spark, d)


@query("""SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN 'number' WHEN 1 THEN 'string' WHEN 2 THEN 'boolean' WHEN 3 THEN 'list' WHEN 4 THEN 'object' WHEN 5 THEN 'null' WHEN 6 THEN 'number' END AS kind,
CASE o_orderkey % 8 WHEN 0 THEN o_orderkey::VARCHAR WHEN 1 THEN o_orderstatus WHEN 2 THEN 'true' WHEN 3 THEN o_orderkey || ',' || o_orderstatus WHEN 4 THEN '[object Object]' WHEN 6 THEN '2.5' END AS shown FROM orders""")
def variant_kinds(spark, d):
    k = F.col("o_orderkey").cast("string")
    quoted = F.concat(F.lit('"'), "o_orderstatus", F.lit('"'))
    texts = [F.concat(k, F.lit(".0")), quoted, F.lit("true"), F.concat(F.lit("["), k, F.lit(","), quoted, F.lit("]")), F.lit('{"a": 1}'), F.lit("null"), F.lit("2.5")]
    value = F.concat(F.lit('{"v": '), F.get(F.array(*texts), (F.col("o_orderkey") % 8).cast("int")), F.lit("}"))
    v = V.at(F.parse_json(F.coalesce(value, F.lit("{}"))), "$.v")
    return table(spark, d, "orders").select("o_orderkey", V.kind(v).alias("kind"), V.shown(v).alias("shown"))


@query("""SELECT 'customers' AS kind, 'C' || c_custkey AS key, c_name AS name, c_nationkey::BIGINT AS nation FROM customer UNION ALL SELECT 'suppliers', 'S' || s_suppkey, s_name, s_nationkey FROM supplier""")
def document_written(spark, d):
    """Two tables as one document of JSON, written by many tasks, put together and read again."""
    def rows(name: str, section: int, kind: str, p: str) -> DataFrame:
        record = F.to_json(F.struct(F.col(f"{p}_name").alias("name"), F.col(f"{p}_nationkey").alias("nation")))
        key = "c_custkey" if p == "c" else "s_suppkey"
        return table(spark, d, name).select(F.lit(section).alias("section"), F.concat(F.lit(kind), F.col(key).cast("string")).alias("key"), record.alias("value"))

    path = fresh_path(spark, "document")
    sections = ("customers", "suppliers")
    ordered.write_document(rows("customer", 0, "C", "c").unionByName(rows("supplier", 1, "S", "s")), f"{path}/parts", exports._json_sections(sections, ""))
    ordered.assemble(spark, f"{path}/parts", f"{path}/whole.json")
    kept = "map<string, struct<name: string, nation: bigint>>"
    whole = spark.read.schema(", ".join(f"{s} {kept}" for s in sections)).json(f"{path}/whole.json", multiLine=True)
    each = [whole.select(F.lit(s).alias("kind"), F.explode(s).alias("key", "r")) for s in sections]
    return each[0].unionByName(each[1]).select("kind", "key", "r.name", "r.nation")


@query("""WITH t AS (SELECT DISTINCT word, -length(word) AS pos FROM (SELECT unnest(string_split(text, ' ')) AS word FROM benchmark) WHERE length(word) > 5),
d AS (SELECT doc_id, lower(text) AS low FROM documents)
SELECT doc_id, first(word ORDER BY pos, word) FILTER (word IS NOT NULL) AS term FROM d LEFT JOIN t ON contains(low, lower(word)) GROUP BY doc_id""")
def dictionary_match(spark, d):
    """The longest word of the benchmark that a document holds."""
    words = table(spark, d, "benchmark").select(F.explode(F.split("text", " ")).alias("term")).where("length(term) > 5").distinct()
    terms = words.select("term", F.col("term").alias("value"), (-F.length("term")).alias("pos"))
    return linkage.first_match_join(table(spark, d, "documents").select("doc_id", "text"), "text", terms, "term").select("doc_id", "term")


@query("""SELECT (SELECT count(DISTINCT c_custkey) FROM customer) AS genus_count, (SELECT count(DISTINCT p_type) FROM part) AS clade_count, 'us' AS attribution,
'2025-03-01T00:00:00.000Z' AS built_at, 'CC-BY-4.0' AS license, '1.0.0' AS schema_version, '2025.03' AS version""")
def metadata_counts(spark, d):
    genera, clades = table(spark, d, "customer").select(F.col("c_custkey").alias("genus")), table(spark, d, "part").select(F.col("p_type").alias("clade"))
    return exports.metadata(genera, clades, dt.datetime(2025, 3, 1, tzinfo=dt.UTC), "us")


# --- texts, numbers and fields ---------------------------------------------------


@query(r"""WITH o AS (SELECT o_orderkey, 'Clerk, A.; Miller B ' || o_orderkey || ', ' || year(o_orderdate) AS a FROM orders)
SELECT o_orderkey, regexp_extract(a, '\b(1[89]\d{2}|20[0-2]\d)\b', 1) AS year,
CASE WHEN regexp_matches(a, '\b(1[89]\d{2}|20[0-2]\d)\b') THEN trim(regexp_replace(regexp_extract(a, '^(.*?)\b(1[89]\d{2}|20[0-2]\d)\b', 1), '[,\s]+$', '')) ELSE a END AS authors FROM o""")
def authority(spark, d):
    a = F.concat(F.lit("Clerk, A.; Miller B "), F.col("o_orderkey").cast("string"), F.lit(", "), F.year("o_orderdate").cast("string"))
    return table(spark, d, "orders").select("o_orderkey", T.authority_year(a).alias("year"), T.authority_authors(a).alias("authors"))


@query("SELECT c_custkey, 'Clerk/' || 'S' || c_nationkey AS surnames FROM customer")
def author_surnames(spark, d):
    a = F.concat(F.lit("Clerk, A.; Jo  S"), F.col("c_nationkey").cast("string"))
    return table(spark, d, "customer").select("c_custkey", F.array_join(T.surnames(a), "/").alias("surnames"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN floor(p_size * 1000 + 0.5)::BIGINT WHEN p_partkey % 3 = 1 THEN floor(p_size * 0.453592::DOUBLE + 0.5)::BIGINT ELSE p_size END::VARCHAR AS kg FROM part""")
def mass(spark, d):
    unit = F.element_at(F.array(F.lit("e/Q11570"), F.lit("e/Q100995"), F.lit("1")), (F.col("p_partkey") % 3 + 1).cast("int"))
    return table(spark, d, "part").select("p_partkey", T.mass_text(F.concat(F.lit("+"), F.col("p_size").cast("string")), unit).alias("kg"))


@query("""WITH s AS (SELECT s_suppkey, s_acctbal / 100 AS lat, s_acctbal / 50 AS lon FROM supplier)
SELECT s_suppkey, CASE WHEN NOT lat BETWEEN -90 AND 90 THEN 'Latitude must be between -90 and 90' WHEN NOT lon BETWEEN -180 AND 180 THEN 'Longitude must be between -180 and 180' END AS problem FROM s""")
def field_coordinates(spark, d):
    value = F.concat((F.col("s_acctbal") / 100).cast("string"), F.lit(", "), (F.col("s_acctbal") / 50).cast("string"))
    return table(spark, d, "supplier").select("s_suppkey", forms.coordinates(value).alias("problem"))


@query("""SELECT o_orderkey, CASE WHEN year(o_orderdate) NOT BETWEEN 1800 AND 1995 THEN 'Enter a valid year (1800–1995)' END AS year_problem,
CASE WHEN o_totalprice <= 1000 THEN 'Must be a positive number' END AS price_problem FROM orders""")
def field_numbers(spark, d):
    o = table(spark, d, "orders")
    price = (F.col("o_totalprice") - 1000).cast("string")
    return o.select("o_orderkey", forms.year(F.year("o_orderdate").cast("string"), F.lit(1995)).alias("year_problem"), forms.positive_number(price).alias("price_problem"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN '"a b" is missing a colon — expected format: source: id' WHEN c_custkey % 4 = 1 THEN '"x:" is missing a source or id'
WHEN c_custkey % 4 = 2 THEN 'Unknown source "y" — known sources: x, z' END AS problem FROM customer""")
def field_identifiers(spark, d):
    value = F.element_at(F.array(F.lit("a b"), F.lit("x:"), F.lit("x: 1\ny: 2"), F.lit("x: 1\n\nz: a:b")), (F.col("c_custkey") % 4 + 1).cast("int"))
    return table(spark, d, "customer").select("c_custkey", forms.identifiers(value, ["x", "z"]).alias("problem"))


@query("SELECT n_nationkey, '/issues/new?labels=a%20b&title=' || replace(n_name, ' ', '%20') || '&body=%23%20x%26(y)!' AS url FROM nation")
def prefilled_url(spark, d):
    return table(spark, d, "nation").select("n_nationkey", forms.prefilled_url("", F.lit("a b"), F.col("n_name"), F.lit("# x&(y)!")).alias("url"))


@query("SELECT p_partkey, CASE WHEN length(p_name) > 6 THEN left(p_name, 6) || '…' ELSE p_name END AS preview, CASE WHEN p_retailprice = floor(p_retailprice) THEN p_retailprice::BIGINT::VARCHAR ELSE p_retailprice::VARCHAR END AS price FROM part")
def preview_numbers(spark, d):
    return table(spark, d, "part").select("p_partkey", S.preview(F.col("p_name"), 6).alias("preview"), S.number_text(F.col("p_retailprice")).alias("price"))


FORM = {
    "label": "Customer",
    "steps": [
        {"name": "who", "fields": [{"header": "Segment", "type": "select", "required": True, "optionsKey": "segments"}, {"header": "Nation", "type": "number", "validate": "positiveNumber"}]},
        {"name": "what", "fields": [
            {"header": "Balance", "type": "text", "validate": "positiveNumber", "showWhen": {"field": "Segment", "value": "BUILDING"}},
            {"header": "Note", "type": "textarea", "required": True, "showWhen": {"field": "Segment", "notEmpty": True, "notValue": "MACHINERY"}},
            {"header": "Marks", "type": "checkboxes", "required": True, "optionsKey": "marks"},
        ]},
    ],
}


@query("""WITH c AS (SELECT c_custkey, c_nationkey, c_acctbal, CASE WHEN c_custkey % 11 = 0 THEN '' ELSE c_mktsegment END AS seg FROM customer), p AS (
SELECT c_custkey, 'Segment' AS header, 'This field is required' AS message FROM c WHERE seg = '' UNION ALL SELECT c_custkey, 'Nation', 'Must be a positive number' FROM c WHERE c_nationkey = 0
UNION ALL SELECT c_custkey, 'Balance', 'Must be a positive number' FROM c WHERE seg = 'BUILDING' AND c_acctbal <= 0 UNION ALL SELECT c_custkey, 'Note', 'This field is required' FROM c WHERE seg NOT IN ('', 'MACHINERY') AND c_custkey % 3 = 0
UNION ALL SELECT c_custkey, 'Marks', 'This field is required' FROM c WHERE c_custkey % 5 = 0) SELECT * FROM p""")
def flow_problems(spark, d):
    c = table(spark, d, "customer")
    given = {
        "Segment": F.when(F.col("c_custkey") % 11 == 0, "").otherwise(F.col("c_mktsegment")), "Nation": F.col("c_nationkey").cast("string"),
        "Balance": F.col("c_acctbal").cast("string"), "Note": F.when(F.col("c_custkey") % 3 > 0, "n"),
    }
    values = F.create_map(*[x for h, v in given.items() for x in (F.lit(h), v)])
    marks = F.when(F.col("c_custkey") % 5 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("a")))
    found = flows.problems(c.select("c_custkey", values.alias("values"), F.create_map(F.lit("Marks"), marks).alias("checked")), FORM, flows.rules([]))
    return found.select("c_custkey", F.explode("problems").alias("header", "message"))


@query(taxonomy.VALUES_SQL)
def taxonomy_values(spark, d):
    return taxonomy.values(spark, d, place_edges(spark, d))


@query("""SELECT conv_id, string_agg('### ' || role || e'\n\n' || text, e'\n\n' ORDER BY turn) AS body FROM conversations WHERE text <> '' GROUP BY conv_id""")
def section_body(spark, d):
    c = table(spark, d, "conversations")
    fields = c.select("conv_id", F.col("turn").alias("pos"), F.col("role").alias("header"), F.array("text").alias("values"), F.lit(None).cast("array<string>").alias("options"))
    return forms.body(fields, "conv_id")


@query("SELECT c_custkey FROM customer WHERE lower(trim(c_mktsegment)) IN ('building', 'machinery')")
def exists_name(spark, d):
    known = spark.createDataFrame([("Building",), ("machinery",)], "name string")
    return linkage.exists_name(table(spark, d, "customer"), {"c_mktsegment": "name"}, known).select("c_custkey")


@query("SELECT c_custkey, CASE c_nationkey WHEN 1 THEN 'One' WHEN 2 THEN 'Two' ELSE c_nationkey::VARCHAR END AS name FROM customer")
def lookup_fallback(spark, d):
    return table(spark, d, "customer").select("c_custkey", linkage.display_name(F.col("c_nationkey").cast("string"), {"1": "One", "2": "Two"}).alias("name"))


def queries() -> dict[str, Query]:
    importlib.import_module(f"{__package__}.written")  # registers its own
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(registry.SQL)
