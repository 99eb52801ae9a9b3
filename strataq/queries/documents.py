"""Trees, amendment recipes and event streams."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from strataq.operators import patch, trees
from strataq.operators.blocks import BLOCK_KEYS, assemble_parts
from strataq.session import spread, table
from strataq.streaming import events as ev


def _stored(spark, d):
    return assemble_parts(spread(table(spark, d, "law_version_blocks")), BLOCK_KEYS)


def block_type_histogram(spark, d):
    """Nodes by type over all blocks; a block delivered twice counts once."""
    n = trees.flatten(_stored(spark, d).dropDuplicates(BLOCK_KEYS))
    return n.groupBy("type").agg(F.count("*").alias("n"), F.max("depth").alias("deepest"), F.sum(F.length("text")).alias("chars"))


def tree_flatten_units(spark, d):
    u = trees.units(trees.flatten(_stored(spark, d)))
    return u.select("norm_id", "version_id", F.array_join(F.transform("unit_path", lambda x: x.cast("string")), ".").alias("path"), "type", "label", "heading", F.length("body").alias("body_length"), F.array_join("subsections", ",").alias("subsections"))


def tree_anchors(spark, d):
    n = trees.flatten(_stored(spark, d).dropDuplicates(BLOCK_KEYS)).where("anchor IS NOT NULL")
    return trees.unique_anchors(n).select("norm_id", "version_id", F.array_join(F.transform("path", lambda x: x.cast("string")), ".").alias("path"), "anchor")


def table_fingerprints(spark, d):
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for n, v, i, raw in b.itertuples(index=False):
                try:
                    block = json.loads(raw)
                except ValueError:
                    continue
                if isinstance(block, dict) and block.get("type") == "table":
                    rows.append((n, v, i, trees.table_fingerprint(block)))
            yield pd.DataFrame(rows, columns=[*BLOCK_KEYS, "fingerprint"])

    return _stored(spark, d).mapInPandas(of, "norm_id string, version_id string, block_index int, fingerprint string").distinct()


def version_text_length(spark, d):
    n = trees.flatten(_stored(spark, d).dropDuplicates(BLOCK_KEYS))
    return n.groupBy("norm_id", "version_id").agg(F.count("*").alias("nodes"), F.sum(F.length("text")).alias("chars"))


def patch_recipe(spark, d):
    """Recipes against whole bodies, one version per date: the first titled provision is renamed, gets a heading and a provision behind it, which is then repealed; a third recipe expects a wrong text and is refused, so the fourth is blocked. Where the target is not the only one, the first is refused."""
    stored = _stored(spark, d).withColumn("k", F.concat_ws("|", "norm_id", "version_id"))
    states = stored.groupBy("k").agg(F.array_sort(F.collect_set(F.struct("block_index", "block_json"))).alias("b")).select("k", F.concat(F.lit('{"title":"t","body":['), F.array_join(F.transform("b", lambda x: x["block_json"]), ","), F.lit("]}")).alias("state_json"))
    label, title = F.get_json_object("block_json", "$.label"), F.get_json_object("block_json", "$.title")
    titled = stored.select("k", "block_index", label.alias("label"), title.alias("title")).where("label != '' AND title != ''")
    first = titled.groupBy("k").agg(F.min(F.struct("block_index", "label", "title")).alias("x")).select("k", "x.label", "x.title")
    renamed, headed = F.concat("label", F.lit("a")), F.concat("title", F.lit(" (neu)"))

    def op(name, day, where, old, field=None, value=None):
        parts = [F.lit(name).alias("op"), where.alias("target"), old.alias("expectedOld"), F.lit(1).alias("expectedMatches"), F.lit("s").alias("source"), F.lit("p").alias("sourceProvision"), F.lit(day).alias("effectiveDate")]
        return F.struct(*parts, *([F.lit(field).alias("field")] if field else []), *([value.alias("value")] if value is not None else []))

    def recipe(seq, day, *ops):
        inner = F.concat_ws(",", *[F.to_json(o) for o in ops])
        return F.struct(F.lit(day).alias("effective_date"), F.lit(seq).alias("seq"), F.concat(F.lit('{"effectiveDate":"' + day + '","operations":['), inner, F.lit("]}")).alias("recipe_json"))

    at = lambda l, t: F.struct(l.alias("label"), t.alias("title"))
    own = F.struct(F.lit("§ 999").alias("label"))
    block = F.struct(F.lit("paragraph").alias("type"), F.lit("§ 999").alias("label"), F.lit("neu").alias("text"))
    one, two, three, four = "2026-01-01", "2026-02-01", "2026-03-01", "2026-04-01"
    recipes = F.array(
        recipe(1, one, op("renameProvision", one, at(F.col("label"), F.col("title")), F.col("label"), "label", renamed), op("replaceHeading", one, at(renamed, F.col("title")), F.col("title"), "title", headed)),
        recipe(2, one, op("insertProvisionAfter", one, at(renamed, headed), headed, "title", block)),
        recipe(3, two, op("repealProvision", two, own, F.lit("neu"))),
        recipe(4, three, op("replaceText", three, own, F.lit("falsch"), None, F.lit("x"))),
        recipe(5, four, op("deleteProvision", four, own, F.lit("(weggefallen)"))),
    )
    done = patch.consolidate(states, first.select("k", F.explode(recipes).alias("r")).select("k", "r.*"), "k")
    v = patch.versions_per_date(done, "k").withColumn("b", F.from_json(F.get_json_object("state_json", "$.body"), "array<struct<label:string,title:string,text:string>>"))
    new = F.filter("b", lambda x: x["label"] == "§ 999")
    changed = F.filter("b", lambda x: F.endswith(x["title"], F.lit(" (neu)")))
    return v.select("k", "effective_date", "status", "recipes", F.size("b").alias("blocks"), F.get(changed, 0)["label"].alias("label"), F.get(changed, 0)["title"].alias("title"), F.get(new, 0)["text"].alias("inserted"))


def wording(spark, d):
    """Texts of the titled blocks against extracts made from the same version's blocks: every third with blanks lost, every fifth with other words."""
    stored = _stored(spark, d).dropDuplicates(BLOCK_KEYS).withColumn("k", F.concat_ws("|", "norm_id", "version_id"))
    t = stored.select("k", F.col("block_index").alias("place"), F.get_json_object("block_json", "$.title").alias("text")).where("text IS NOT NULL")
    x = F.when(F.col("place") % 5 == 4, F.lit("etwas anderes")).when(F.col("place") % 3 == 2, F.replace("text", F.lit(" "), F.lit(""))).otherwise(F.concat(F.lit("Vor "), F.replace("text", F.lit(" "), F.lit("\n  ")), F.lit(" nach")))
    extracts = t.select("k", "place", x.alias("extract"))
    # a text is looked for in the extract of its place
    key = F.concat_ws("#", "k", "place")
    done = patch.wording_check(t.withColumn("k", key), extracts.withColumn("k", key).drop("place"), "k")
    return done.groupBy("verdict").agg(F.count("*").alias("n"))


def file_plan(spark, d):
    """Objects that a run would write against those there: the base inventory planned, the check inventory found."""
    src = table(spark, d, "law_source_objects").withColumn("path", F.concat_ws("/", "norm_id", "version_id"))
    side = lambda role: src.where(F.col("source_role") == role).groupBy("path").agg(F.min("sha256").alias("sha256"), F.max("sha256").alias("base_sha256"))
    return patch.file_plan(side("base"), side("check")).groupBy("action").agg(F.count("*").alias("n"))


def tumbling_window(spark, d):
    return ev.tumbling(table(spark, d, "events"), "ts", ["event_type"], "1 day")


def sliding_window(spark, d):
    return ev.sliding(table(spark, d, "events"), "ts", ["event_type"], "12 hours", "6 hours")


def session_windows(spark, d):
    return ev.sessions(table(spark, d, "events"), "ts", ["user_id"], "1 day")


def dedupe_within_watermark(spark, d):
    return ev.deduplicate(table(spark, d, "events"), "ts", ["user_id", "event_type"]).select("user_id", "event_type", "event_id")


def stream_tumbling(spark, d):
    """The daily windows from a stream with a watermark; windows that it has closed are written."""
    out = ev.run_available(ev.tumbling(ev.event_stream(spark, d), "ts", ["event_type"], "1 day"))
    return spark.read.schema("event_type string, window_start timestamp, n long, total double").parquet(out)


def stream_totals(spark, d):
    """Totals per user from keyed state, after all that is there."""
    out = ev.run_available(ev.running_totals(ev.event_stream(spark, d)), "update")
    return spark.read.parquet(out).groupBy("user_id").agg(F.max("n").alias("n"), F.max_by("total", "n").alias("total"))


_WHOLE = "WITH parts AS (SELECT DISTINCT * FROM law_version_blocks WHERE part_index >= 0 AND part_index < part_count), whole AS (SELECT norm_id, version_id, block_index, string_agg(block_json, '' ORDER BY part_index) AS j, count(*) AS n, max(part_count) AS pc FROM parts GROUP BY ALL HAVING n = pc) "

QUERIES = {f.__name__: f for f in (block_type_histogram, tree_flatten_units, tree_anchors, table_fingerprints, version_text_length, patch_recipe, wording, file_plan, tumbling_window, sliding_window, session_windows, dedupe_within_watermark, stream_tumbling, stream_totals)}

SQL = {
    "block_type_histogram": _WHOLE + """, nodes AS (SELECT t.id, t.parent, t.key, t.type AS jt, t.atom ->> '$' AS v, fullkey, norm_id, version_id, block_index FROM whole, json_tree(CAST(j AS JSON)) t WHERE t.key IN ('type', 'text') AND t.type = 'VARCHAR'),
o AS (SELECT norm_id, version_id, block_index, parent, max(v) FILTER (key = 'type') AS type, max(length(v)) FILTER (key = 'text') AS chars, max(len(string_split(fullkey, 'children')) - 1) AS depth FROM nodes GROUP BY ALL)
SELECT type, count(*) AS n, CAST(max(depth) AS INTEGER) AS deepest, sum(chars) AS chars FROM o GROUP BY type""",
    "version_text_length": _WHOLE + ", t AS (SELECT norm_id, version_id, t.key, t.atom ->> '$' AS v FROM whole, json_tree(CAST(j AS JSON)) t WHERE t.key IN ('type', 'text') AND t.type = 'VARCHAR') SELECT norm_id, version_id, count(*) FILTER (key = 'type') AS nodes, sum(length(v)) FILTER (key = 'text') AS chars FROM t GROUP BY ALL",
    "patch_recipe": _WHOLE + """, c AS (SELECT norm_id || '|' || version_id AS k, block_index, json_extract_string(j, '$.label') AS label, json_extract_string(j, '$.title') AS title, j FROM whole),
f AS (SELECT k, arg_min(label, block_index) AS label, arg_min(title, block_index) AS title FROM c WHERE label <> '' AND title <> '' GROUP BY k), n AS (SELECT k, count(*) AS blocks FROM c GROUP BY k),
node AS (SELECT k, max(t.atom ->> '$') FILTER (t.key = 'label') AS l, max(t.atom ->> '$') FILTER (t.key = 'title') AS t FROM c, json_tree(CAST(j AS JSON)) t WHERE t.key IN ('label', 'title') AND t.type = 'VARCHAR' GROUP BY k, block_index, t.parent),
h AS (SELECT f.k, f.label, f.title, blocks, count(*) FILTER (l = f.label AND t = f.title) AS hits FROM f JOIN n USING (k) JOIN node USING (k) GROUP BY ALL),
r AS (SELECT h.*, d.* FROM h, (VALUES ('2026-01-01', 2), ('2026-02-01', 1), ('2026-03-01', 1), ('2026-04-01', 1)) d(effective_date, recipes))
SELECT k, effective_date, CASE WHEN hits = 1 THEN CASE effective_date WHEN '2026-03-01' THEN 'refused' WHEN '2026-04-01' THEN 'blocked' ELSE 'applied' END WHEN effective_date = '2026-01-01' THEN 'refused' ELSE 'blocked' END AS status, recipes,
CASE WHEN ok THEN blocks + 1 END AS blocks, CASE WHEN ok THEN label || 'a' END AS label, CASE WHEN ok THEN title || ' (neu)' END AS title, CASE WHEN ok THEN CASE effective_date WHEN '2026-01-01' THEN 'neu' ELSE '(weggefallen)' END END AS inserted
FROM (SELECT *, hits = 1 AND effective_date < '2026-03-01' AS ok FROM r)""",
    "wording": _WHOLE + ", t AS (SELECT block_index AS place, json_extract_string(j, '$.title') AS text FROM whole) SELECT CASE WHEN place % 5 = 4 THEN 'missing' WHEN place % 3 = 2 AND contains(trim(text), ' ') THEN 'loose' ELSE 'exact' END AS verdict, count(*) AS n FROM t WHERE text IS NOT NULL GROUP BY 1",
    "file_plan": "WITH s AS (SELECT norm_id || '/' || version_id AS p, min(sha256) FILTER (source_role = 'base') AS a, max(sha256) FILTER (source_role = 'base') AS b, min(sha256) FILTER (source_role = 'check') AS now, count(*) FILTER (source_role = 'base') AS na, count(*) FILTER (source_role = 'check') AS nb FROM law_source_objects WHERE source_role IN ('base', 'check') GROUP BY 1) SELECT CASE WHEN na = 0 THEN 'orphan' WHEN now IS NULL THEN 'new' WHEN now = a THEN 'unchanged' WHEN now = b THEN 'update' ELSE 'conflict' END AS action, count(*) AS n FROM s GROUP BY 1",
    "tumbling_window": "SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) AS window_start, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL",
    "sliding_window": "SELECT event_type, w AS window_start, count(*) AS n FROM (SELECT event_type, unnest([time_bucket(INTERVAL 6 HOUR, ts), time_bucket(INTERVAL 6 HOUR, ts) - INTERVAL 6 HOUR]) AS w FROM events) GROUP BY ALL",
    "session_windows": "SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT *, CASE WHEN ts <= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 1 DAY THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, s",
    "dedupe_within_watermark": "SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1",
    "stream_totals": "SELECT user_id, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY user_id",
}
