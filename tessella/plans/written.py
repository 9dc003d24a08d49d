"""Texts and documents that the library writes from the plain tables, read back, each beside the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import semantics as S
from ..functions import text as T
from ..operators import forms, hierarchy, linkage, rules
from ..scratch import fresh_path
from ..sinks import exports, ordered
from ..sources import candidates
from . import driver, taxonomy
from .registry import dealt, query, table


def lines_of(spark: SparkSession, write) -> DataFrame:
    """The lines of what ``write`` makes at a path that it is given."""
    path = fresh_path(spark, "document")
    write(f"{path}/parts")
    ordered.assemble(spark, f"{path}/parts", f"{path}/whole.txt")
    return spark.read.text(f"{path}/whole.txt").select(F.col("value").alias("line"))


@query("""WITH s AS (SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')), b AS (SELECT c_custkey FROM customer WHERE c_acctbal <= 0),
n AS (SELECT (SELECT count(*) FROM s) AS w, (SELECT count(*) FROM b) AS e)
SELECT 0 AS pos, '⚠ segment: ' || w || ' warning' || CASE w WHEN 1 THEN '' ELSE 's' END AS line FROM n UNION ALL SELECT 1, '  ' || c_custkey || ': invalid segment ' || c_mktsegment FROM s
UNION ALL SELECT 2, '✗ balance: ' || e || ' error' || CASE e WHEN 1 THEN '' ELSE 's' END FROM n UNION ALL SELECT 3, '  ' || c_custkey || ': balance must be positive' FROM b
UNION ALL SELECT 4, '✓ nothing check passed' UNION ALL SELECT 6, e'\nSummary: ' || e || ' error' || CASE e WHEN 1 THEN '' ELSE 's' END || ', ' || w || ' warning' || CASE w WHEN 1 THEN '' ELSE 's' END FROM n""")
def report_text(spark, d):
    c = table(spark, d, "customer")
    allowed = spark.createDataFrame([("BUILDING",), ("MACHINERY",)], "value string")
    segments = rules.vocabulary_findings(c, "c_mktsegment", allowed, "segment", F.col("c_custkey"), F.concat(F.lit("invalid segment "), "c_mktsegment"), rules.WARNING)
    balance = rules.row_findings(c, [rules.positive("balance", "c_acctbal", F.lit("balance must be positive"))], F.col("c_custkey"))
    return rules.report_lines(rules.gather(segments, balance), ["segment", "balance", "nothing"])


_NEWICK = """(SELECT '(' || string_agg(CASE WHEN s IS NULL THEN r_name ELSE '(' || s || ')' || r_name END, ',' ORDER BY r_regionkey) || ')World;'
FROM (SELECT r_regionkey, r_name, string_agg(n_name, ',' ORDER BY n_nationkey) AS s FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY ALL))"""


@query(f"""SELECT 'newick' AS kind, e'[us]\\n' || {_NEWICK} || e'\\n' AS value UNION ALL
SELECT 'nexus', e'#NEXUS\\n[! us ]\\n\\nBEGIN TAXA;\\n  DIMENSIONS NTAX=' || count(*) || e';\\n  TAXLABELS ' || string_agg(n_name, ' ' ORDER BY r_regionkey, n_nationkey) || e';\\nEND;\\n\\nBEGIN TREES;\\n  TREE places = ' || {_NEWICK} || e'\\nEND;\\n'
FROM region JOIN nation ON n_regionkey = r_regionkey""")
def tree_files(spark, d):
    edges = driver.place_edges(spark, d)
    files = {"newick": exports.newick_file(edges, "us"), "nexus": exports.nexus_file(edges, "us", "places")}
    both = [f.select(F.lit(k).alias("kind"), "value") for k, f in files.items()]
    return both[0].unionByName(both[1])


@query("""SELECT count(*) AS nodes, count(DISTINCT node) AS names, count(*) FILTER (leaf) AS leaves FROM (SELECT 'R' || r_regionkey AS node, r_regionkey NOT IN (SELECT n_regionkey FROM nation) AS leaf FROM region
UNION ALL SELECT 'N' || n_nationkey, n_nationkey NOT IN (SELECT c_nationkey FROM customer) FROM nation UNION ALL SELECT 'C' || c_custkey, true FROM customer)""")
def tree_counts(spark, d):
    edges = driver.order_edges(spark, d, orders=False)
    parts = [hierarchy.nodes(edges).agg(F.count("*").alias("nodes")), hierarchy.node_set(edges).agg(F.count("*").alias("names")), hierarchy.leaves(edges).agg(F.count("*").alias("leaves"))]
    return parts[0].crossJoin(parts[1]).crossJoin(parts[2])  # one row each


@query("""WITH c AS (SELECT c_custkey, CASE c_custkey % 2 WHEN 0 THEN '  ' || upper(c_name) || ' ' ELSE c_name || 'x' END AS n, lower(c_mktsegment) AS seg FROM customer)
SELECT c.c_custkey, CASE WHEN o.c_name IS NOT NULL THEN '"' || o.c_name || '" already exists under ' || seg || ' — use the edit flow instead' END AS problem
FROM c LEFT JOIN (SELECT c_name, c_mktsegment FROM customer WHERE c_custkey % 3 = 0) o ON lower(o.c_name) = lower(trim(n)) AND lower(o.c_mktsegment) = seg""")
def new_names(spark, d):
    c = table(spark, d, "customer")
    given = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("  "), F.upper("c_name"), F.lit(" "))).otherwise(F.concat("c_name", F.lit("x")))
    have = c.where("c_custkey % 3 = 0").select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("kept"))
    have = have.unionByName(have.withColumn("name", F.lower("name")))  # names that differ by case alone
    return forms.new_name(c.select("c_custkey", given.alias("n"), F.lower("c_mktsegment").alias("seg")), "n", have, "edit", {"seg": "kept"}).select("c_custkey", "problem")


@query("""WITH t AS (SELECT 'World' AS node UNION ALL SELECT r_name FROM region UNION ALL SELECT n_name FROM nation)
SELECT unnest(['{', '  "diet": [', '    "a",', '    "b"', '  ],', '  "countries": {', '    "A": "a",', '    "Z": "z"', '  },', '  "stages": null,', '  "clades": [', '  ]', '}']) AS line
UNION ALL SELECT '    "' || node || CASE WHEN node = (SELECT max(node) FROM t) THEN '"' ELSE '",' END FROM t""")
def lookups_written(spark, d):
    schema = {"diet": ["b", "a"], "countries": {"Z": "z", "A": "a"}}
    return lines_of(spark, lambda path: exports.write_lookups(schema, driver.place_edges(spark, d), path))


@query("""SELECT DISTINCT word AS line FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part UNION ALL SELECT n_name FROM nation) WHERE word <> '' UNION ALL SELECT '# words'""")
def words_written(spark, d):
    words = exports.distinct_words([table(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("word")), table(spark, d, "nation").select("n_name")])
    return lines_of(spark, lambda path: exports.write_word_list(words, path, ["words"]))


@query(f"""SELECT unnest(string_split(rtrim(value, e'\\n'), e'\\n')) AS line FROM ({taxonomy.REFERENCES_SQL}) UNION ALL SELECT unnest(['% us', ''])""")
def bibliography_written(spark, d):
    t = taxonomy.taxonomy(spark, d, driver.place_edges(spark, d))
    return lines_of(spark, lambda path: exports.write_bibliography(t.genera.where("_error IS NULL"), t.clades.where("_error IS NULL"), path, ["us"]))


@query("""SELECT unnest(['regions:', 'nations:', 'none: {}']) AS line UNION ALL SELECT unnest(['  ' || r_name || ':', '    key: ' || r_regionkey]) FROM region
UNION ALL SELECT unnest(['  ' || n_name || ':', '    key: ' || n_nationkey, '    region: ' || r_name]) FROM nation JOIN region ON n_regionkey = r_regionkey""")
def yaml_written(spark, d):
    region, nation = table(spark, d, "region"), table(spark, d, "nation")
    rows = region.select(F.lit(0).alias("section"), F.col("r_name").alias("key"), F.to_json(F.struct(F.col("r_regionkey").alias("key"))).alias("value"))
    named = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    rows = rows.unionByName(named.select(F.lit(1).alias("section"), F.col("n_name").alias("key"), F.to_json(F.struct(F.col("n_nationkey").alias("key"), F.col("r_name").alias("region"))).alias("value")))
    sections = tuple(ordered.Section(f"{n}:\n", empty=f"{n}: {{}}\n") for n in ("regions", "nations", "none"))
    return lines_of(spark, lambda path: ordered.write_document(rows, path, ordered.Layout(sections, form="yaml", indent=2)))


@query(r"""WITH t AS (SELECT c_custkey, 'id: ' || c_name || e'\n  options:  # sync:schema:' || CASE c_custkey % 3 WHEN 0 THEN 'none' ELSE 'kinds' END || e'\n' AS head, CASE c_custkey % 3 WHEN 1 THEN e'    - a\n    - b\n' ELSE e'    - old\n' END AS items FROM customer)
SELECT c_custkey, head || CASE c_custkey % 3 WHEN 0 THEN items ELSE e'    - a\n    - b\n' END || e'tail: 1\n' AS updated, c_custkey % 3 = 2 AS drift FROM t""")
def templates_synced(spark, d):
    k = F.col("c_custkey") % 3
    text = F.concat(F.lit("id: "), "c_name", F.lit("\n  options:  # sync:schema:"), F.when(k == 0, "none").otherwise("kinds"), F.lit("\n"), F.when(k == 1, "    - a\n    - b\n").otherwise("    - old\n"), F.lit("tail: 1\n"))
    return forms.sync_templates(table(spark, d, "customer").select("c_custkey", text.alias("text")), {("schema", "kinds"): ["b", "a"]}).select("c_custkey", "updated", "drift")


@query("""WITH n AS (SELECT 'C' || lpad(n_nationkey::VARCHAR, 2, '0') AS code, n_name FROM nation), c AS (SELECT c_custkey, n_name AS own, CASE WHEN c_custkey % 4 > 0 THEN 'near ' || lower(n_name) ELSE 'far' END AS text FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, first(code ORDER BY code) FILTER (contains(text, lower(n_name))) AS code, first(code) FILTER (n_name = own) AS inverse FROM c, n GROUP BY c_custkey""")
def country_codes(spark, d):
    nation = table(spark, d, "nation")
    countries = {f"C{r.n_nationkey:02}": r.n_name for r in nation.select("n_nationkey", "n_name").limit(1000).collect()}  # a schema's list
    c = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    text = F.when(F.col("c_custkey") % 4 > 0, F.concat(F.lit("near "), F.lower("n_name"))).otherwise("far")
    return c.select("c_custkey", linkage.match_country(text, countries).alias("code"), linkage.code_of(F.col("n_name"), countries).alias("inverse"))


@query(r"""WITH p AS (SELECT p_partkey AS k, 'P ' || p_partkey AS subject, p_name FROM part)
SELECT subject, 'Type species name' AS header, 'P' || k || ' a' AS value FROM p UNION ALL SELECT subject, 'Period', 'Jurassic' FROM p WHERE k % 3 > 0 UNION ALL SELECT subject, 'Authors', 'Marsh, O.' FROM p
UNION ALL SELECT subject, 'Year described', (1850 + k % 100)::VARCHAR FROM p UNION ALL SELECT subject, 'Genus description', CASE k % 2 WHEN 0 THEN 'Short text.' ELSE 'P' || k || ' was a large thing here.' END FROM p
UNION ALL SELECT subject, 'Genus etymology', 'From ' || p_name || '. More.' FROM p WHERE k % 5 > 0 UNION ALL SELECT subject, 'Pronunciation (IPA)', '/p' || k || '/' FROM p WHERE k % 7 = 0""")
def article_candidates(spark, d):
    k = F.col("p_partkey").cast("string")
    page = F.concat(
        F.lit("{{Short|x}}\n{{Taxobox\n| name = x\n| type = ''P"), k, F.lit(" a''\n| temporal_range = "), F.when(F.col("p_partkey") % 3 > 0, "Late {{small|x}} [[Jurassic]]").otherwise("old"),
        F.lit("\n| authority = Marsh, O., "), (F.col("p_partkey") % 100 + 1850).cast("string"), F.lit("\n}}\n{{Other\nInside it\n}}\n[[File:a.jpg|b]]\nlower case\n'''P"), k,
        F.lit("''' was a [[thing|large thing]]<ref>no</ref> here.\n\n== Etymology ==\nFrom "), "p_name", F.lit(".<ref name=\"a\"/>\nMore.\n=== Sub ===\nno\n== Next ==\nno\n"),
    )
    sections = F.when(F.col("p_partkey") % 5 > 0, F.array(F.struct(F.lit("Etymology").alias("line"), F.lit("2").alias("level"))))
    html = F.when(F.col("p_partkey") % 7 == 0, F.concat(F.lit('<span class="IPA nowrap" lang="en-fonipa"><a href="x">/<b>p'), k, F.lit("</b>/</a></span>")))
    extract = F.when(F.col("p_partkey") % 2 == 0, "Short (  ) text.\nmore")
    pages = dealt(table(spark, d, "part").select("p_partkey", "p_name")).select(F.concat(F.lit("P "), k).alias("subject"), page.alias("wikitext"), sections.alias("sections"), html.alias("html"), extract.alias("extract"))
    return candidates.from_articles(candidates.article_fields(pages), {"periods": ["Jurassic"]}).select("subject", "header", "value")


@query(taxonomy._ROWS + """SELECT 'genus' AS kind, CASE f WHEN 3 THEN 'T' ELSE 'S' END || k AS key, CASE f WHEN 2 THEN '' ELSE 'World/' || r_name || '/' || g.nation END AS path FROM g JOIN nation n ON n_name = g.nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT 'clade', r_name, 'World/' || r_name FROM region UNION ALL SELECT 'clade', n_name, 'World/' || r_name || '/' || n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 7 <> 6
UNION ALL SELECT DISTINCT 'clade', p_type, '' FROM part""")
def dataset_paths(spark, d):
    edges = driver.place_edges(spark, d)
    t = taxonomy.taxonomy(spark, d, edges)
    lines = exports.dataset_lines(t.genera, t.clades, edges)
    return lines.select("kind", "key", F.array_join(F.from_json("value", "taxonomy array<string>")["taxonomy"], "/").alias("path"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y.%m') AS version FROM orders")
def version_texts(spark, d):
    return table(spark, d, "orders").select("o_orderkey", S.version_text(F.col("o_orderdate")).alias("version"))


@query("SELECT conv_id, arg_min(role, turn) AS role, arg_min(text, turn) AS text FROM conversations GROUP BY conv_id")
def first_records(spark, d):
    return candidates.first_record(table(spark, d, "conversations"), "conv_id", "turn").select("conv_id", "role", "text")


@query("SELECT p_partkey, 'P ' || p_partkey || ' is ' || p_brand || '.' AS text FROM part")
def first_paragraphs(spark, d):
    text = F.concat(F.lit("P ( ) "), F.col("p_partkey").cast("string"), F.lit("   is(  )"), "p_brand", F.lit(".\nmore ( )\n"))
    return table(spark, d, "part").select("p_partkey", T.first_paragraph(text).alias("text"))


@query("SELECT p_partkey, true AS same, p_name || '(x)*' = p_name || 'x' AS other FROM part")
def escaped_patterns(spark, d):
    """A text matches its own escaped form and no other."""
    name = F.concat("p_name", F.lit("(x)*"))
    pattern = F.concat(F.lit("^"), T.escape_regex(name), F.lit("$"))
    return table(spark, d, "part").select("p_partkey", F.regexp_like(name, pattern).alias("same"), F.regexp_like(F.concat("p_name", F.lit("x")), pattern).alias("other"))
