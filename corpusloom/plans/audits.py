"""Queries of the file audit, gates and set arithmetic."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import audit, gates, linter
from . import relations as R
from .registry import query


@query(
    "audit_duplicates",
    f"WITH {R.FILES} SELECT sha256(content) AS sha256, size_bytes, count(*) AS copies, string_agg(path, ',' ORDER BY path) AS files FROM files WHERE size_bytes > 0 GROUP BY 1, 2 HAVING count(*) > 1",
)
def duplicates(spark, sf_dir):
    groups = audit.duplicate_groups(R.files(spark, sf_dir).select("path", "size_bytes", "content"))
    return groups.withColumn("files", F.array_join("files", ","))


@query("audit_totals", f"WITH {R.FILES} SELECT root, count(*) AS file_count, sum(size_bytes)::BIGINT AS total_bytes FROM files GROUP BY ROLLUP (root)")
def totals(spark, sf_dir):
    return audit.totals(R.files(spark, sf_dir))


@query("audit_extensions", f"WITH {R.FILES} SELECT root, extension, count(*) AS file_count FROM files GROUP BY 1, 2")
def extensions(spark, sf_dir):
    return audit.extension_counts(audit.inventory(R.files(spark, sf_dir)))


@query(
    "audit_root_summary",
    f"WITH {R.FILES}, e AS (SELECT root, extension, count(*) AS n, sum(size_bytes) AS b FROM files GROUP BY 1, 2) SELECT root, sum(n)::BIGINT AS file_count, sum(b)::BIGINT AS total_bytes, string_agg(extension || '=' || n, ',' ORDER BY extension) AS extensions FROM e GROUP BY 1",
)
def root_summary(spark, sf_dir):
    s = audit.root_summary(R.files(spark, sf_dir))
    return s.withColumn("extensions", F.array_join(F.transform(F.map_entries("extensions"), lambda e: F.concat_ws("=", e.getField("key"), e.getField("value"))), ","))


@query("audit_system_files", "SELECT page_id, len(list_filter(string_split(url, '/'), lambda x: x = '.DS_Store' OR starts_with(x, '._'))) > 0 AS system FROM pages")
def system_files(spark, sf_dir):
    return R.table(spark, sf_dir, "pages").select("page_id", audit.is_system_file(F.col("url")).alias("system"))


@query(
    "audit_extension_of",
    "SELECT page_id, CASE WHEN e = '' THEN '[no extension]' ELSE e END AS extension FROM (SELECT page_id, lower(regexp_extract(url, '[^/.][^/]*(\\.[^./]+)$', 1)) AS e FROM pages)",
)
def extension_of(spark, sf_dir):
    return R.table(spark, sf_dir, "pages").select("page_id", audit.extension_of(F.col("url")).alias("extension"))


@query("links", "SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]+)\"', 1)) AS link FROM pages")
def links(spark, sf_dir):
    return R.table(spark, sf_dir, "pages").select("page_id", F.explode(T.find_all(F.col("html"), 'href="([^"]+)"', 1)).alias("link"))


@query("lint_names", "SELECT 'x/' || p_name AS folder, 'name ''' || p_name || ' X'' must be lowercase hyphen-case' AS error FROM part UNION ALL SELECT 'x/' || p_name, 'name ''' || p_name || ' X'' does not match folder ''' || p_name || '''' FROM part")
def lint_names(spark, sf_dir):
    name = F.col("p_name")
    folders = R.dealt_table(spark, sf_dir, "part").select(F.concat(F.lit("x/"), name).alias("folder"), F.concat(F.lit("---\nname: "), name, F.lit(" X\ndescription: d\n---\n")).alias("content"))
    return linter.errors(folders, spark.createDataFrame([], "path string"))


@query("g1_duplicates_in_order", f"WITH {R.FILES}, g AS (SELECT size_bytes, sha256(content) AS sha256, count(*) AS copies FROM files WHERE size_bytes > 0 GROUP BY 1, 2 HAVING count(*) > 1) SELECT row_number() OVER (ORDER BY size_bytes, sha256) AS place, size_bytes, sha256, copies FROM g")
def duplicates_in_order(spark, sf_dir):
    return audit.in_order(audit.duplicate_groups(R.files(spark, sf_dir).select("path", "size_bytes", "content"))).select("place", "size_bytes", "sha256", "copies")


_CONTENT = "CASE p_partkey % 6 WHEN 0 THEN 'System-neutral GM sheets' WHEN 1 THEN 'Source ZIP, preview, obsolete release, or translation snapshot' WHEN 2 THEN 'Campaign notes, house rules, and active characters' WHEN 3 THEN 'Setting book, setting map, or licensed adaptation' END"
_HOME = "CASE p_partkey % 6 WHEN 0 THEN '03 Shared Resources/03 Generic Sheets' WHEN 1 THEN 'Owning library `90 Archive`' WHEN 2 THEN 'Owning library `My Table`' WHEN 3 THEN 'Owning game or setting' END"


@query("c17_routing", f"SELECT p_partkey, {_HOME} AS home, CASE WHEN {_HOME} IS NULL THEN 'needs review' ELSE 'move' END AS action FROM part")
def routing(spark, sf_dir):
    return audit.route(R.table(spark, sf_dir, "part").select("p_partkey", F.expr(_CONTENT).alias("content"))).select("p_partkey", "home", "action")


_ACTION = f"CASE WHEN p_partkey % 13 = 0 THEN 'leave in source' WHEN p_partkey % 13 = 1 THEN 'needs review' WHEN p_partkey % 13 = 2 THEN 'trash exact duplicate' WHEN p_partkey % 6 = 1 AND p_partkey % 7 > 0 THEN 'archive' WHEN p_partkey % 6 = 0 OR (p_partkey % 6 IN (2, 3) AND p_partkey % 7 > 0) THEN 'move' ELSE 'needs review' END"


@query(
    "l8_manifest",
    f"""SELECT p_name AS source, CASE action WHEN 'leave in source' THEN NULL WHEN 'needs review' THEN CASE WHEN k = 1 THEN '00 Inbox/02 Needs Review' ELSE '00 Inbox/01 Unassigned' END WHEN 'trash exact duplicate' THEN 'lib/one' WHEN 'archive' THEN 'lib/90 Archive'
    ELSE CASE p_partkey % 6 WHEN 0 THEN '03 Shared Resources/03 Generic Sheets' WHEN 2 THEN 'lib/My Table' ELSE 'lib' END END AS destination, action, CASE action WHEN 'trash exact duplicate' THEN 'exact' WHEN 'needs review' THEN 'uncertain' ELSE 'clear' END AS confidence,
    CASE action WHEN 'trash exact duplicate' THEN 'same SHA-256' WHEN 'leave in source' THEN 'out of scope' ELSE coalesce({_CONTENT}, 'unknown content') END AS reason, 'h' || p_size AS hash FROM (SELECT *, p_partkey % 13 AS k, {_ACTION} AS action FROM part)""",
)
def manifest(spark, sf_dir):
    k = F.col("p_partkey") % 13
    items = R.table(spark, sf_dir, "part").select(F.col("p_name").alias("path"), F.expr(_CONTENT).alias("content"), F.when(k == 0, False).when(k > 1, True).alias("confirmed"), F.when(F.col("p_partkey") % 7 > 0, "lib").alias("library"), F.when(k == 2, "lib/one").alias("canonical"), F.concat(F.lit("h"), F.col("p_size").cast("string")).alias("sha256"))
    return audit.manifest(items)


@query(
    "front_matter_lint",
    """SELECT folder, error FROM (SELECT 'src/part-' || p_partkey AS folder, unnest([CASE WHEN p_size % 5 = 0 THEN 'front matter missing ''description''' END,
       CASE WHEN p_size % 3 = 0 THEN 'name ''' || p_partkey || ''' does not match folder ''part-' || p_partkey || '''' END,
       CASE WHEN p_size % 2 = 0 THEN 'referenced file does not exist: references/' || p_size || '.md' END]) AS error FROM part) WHERE error IS NOT NULL""",
)
def front_matter_lint(spark, sf_dir):
    p = R.dealt_table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    name = F.when(F.col("p_size") % 3 == 0, key).otherwise(F.concat(F.lit("part-"), key))
    about = F.when(F.col("p_size") % 5 == 0, F.lit("")).otherwise(F.lit('"a part"'))
    content = F.concat(F.lit("---\nname: "), name, F.lit("\ndescription: "), about, F.lit("\n---\nsee [x](references/"), F.col("p_size").cast("string"), F.lit(".md) and [y](https://example.com)"))
    folders = p.select(F.concat(F.lit("src/part-"), key).alias("folder"), content.alias("content"), "p_size")
    paths = folders.filter("p_size % 2 = 1").select(F.concat(F.col("folder"), F.lit("/references/"), F.col("p_size").cast("string"), F.lit(".md")).alias("path"))
    return linter.errors(folders.select("folder", "content"), paths)


@query(
    "coverage_missing",
    "WITH r AS (SELECT o_custkey AS first, o_custkey + 2 AS last FROM orders), c AS (SELECT DISTINCT unnest(generate_series(first, last)) AS page FROM r) SELECT c_custkey AS page FROM customer WHERE c_custkey NOT IN (SELECT page FROM c)",
)
def coverage_missing(spark, sf_dir):
    r = R.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("first"), (F.col("o_custkey") + 2).alias("last"))
    return gates.uncovered(R.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("page")), r)


_LEDGER = "1-40,60 - 70 ,x-3,5-2,90"


@query(
    "coverage_gate",
    "WITH n AS (SELECT n_nationkey + 1 AS page FROM nation), c AS (SELECT unnest(generate_series(1, 20)) AS page UNION SELECT 24) SELECT count(*) FILTER (c.page IS NULL) = 0 AS ok, count(*) FILTER (c.page IS NULL) AS missing, string_agg(n.page::VARCHAR, ',' ORDER BY n.page) FILTER (c.page IS NULL) AS first_missing, 1 AS corrections FROM n LEFT JOIN c ON n.page = c.page",
)
def coverage_gate(spark, sf_dir):
    pages = R.table(spark, sf_dir, "nation").select((F.col("n_nationkey") + 1).alias("page"))
    ledger = spark.createDataFrame([("# Cobertura: 1-20, 24,x-3,9-5",), ("page\tchange",), ("# a\tb",)], "line string")
    return gates.gate(pages, ledger).withColumn("first_missing", F.array_join("first_missing", ","))


@query("rows_missing", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def rows_missing(spark, sf_dir):
    done = R.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return gates.not_done(R.table(spark, sf_dir, "customer").select("c_custkey"), done, ["c_custkey"])


@query("pages_remaining", "SELECT count(*) AS total, count(*) FILTER (o) AS ready, count(*) FILTER (NOT o) AS remaining FROM (SELECT c_custkey IN (SELECT o_custkey FROM orders) AS o FROM customer)")
def pages_remaining(spark, sf_dir):
    return gates.remaining(R.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("page")), R.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("page")))


@query(
    "bag_difference",
    "SELECT l_partkey, l_suppkey FROM lineitem EXCEPT ALL SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'",
)
def bag_difference(spark, sf_dir):
    li = R.table(spark, sf_dir, "lineitem")
    return gates.bag_difference(li.select("l_partkey", "l_suppkey"), li.filter("l_returnflag = 'R'").select("l_partkey", "l_suppkey"))


@query(
    "progress_update",
    "SELECT c_custkey AS pdf_page, CASE WHEN m IS NOT NULL THEN m WHEN c_acctbal > 0 THEN 'ok' END AS ocr FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderstatus) AS m FROM orders GROUP BY 1) ON c_custkey = o_custkey",
)
def progress_update(spark, sf_dir):
    status = R.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pdf_page"), F.when(F.col("c_acctbal") > 0, "ok").alias("ocr"))
    changes = R.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("pdf_page"), F.col("o_orderstatus").alias("ocr"))
    known = status.select(F.col("pdf_page").alias("k"))
    return gates.update_progress(status, changes.join(known, F.col("pdf_page") == F.col("k"), "left_semi"), "pdf_page", "ocr")


@query("section_ranges", "SELECT user_id, start, coalesce(lead(start) OVER (PARTITION BY user_id ORDER BY start) - 1, start) AS \"end\" FROM (SELECT user_id, event_id AS start FROM events WHERE event_type = 'signup')")
def section_ranges(spark, sf_dir):
    from ..operators import shape

    s = R.table(spark, sf_dir, "events").filter("event_type = 'signup'").select("user_id", F.col("event_id").alias("start"))
    return shape.section_ranges(s, by=["user_id"])
