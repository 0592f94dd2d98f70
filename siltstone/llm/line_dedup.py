"""Line dedup over windows of consecutive lines.

All in DataFrame operations: lines are hashed, each run of ``width`` lines becomes a
window (128 bits of hash), windows are grouped with map-side combining to find
the first occurrence of each repeated one, and each later occurrence covers its lines.
Windows are made once (checkpointed, 48 bytes each).  The first occurrences of windows that hold a thousandth of all
repeats or more are broadcast, so a boilerplate window's rows stay where they are.
Texts are shuffled once, to meet the covered line numbers of their document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import cut, importable, spread_join


def remove_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """Removes lines covered by a later occurrence of ``width`` consecutive lines.

    Lines are split at "\\n" and compared as they are.  The first occurrence of
    a window, by (id, hash of the text, line number), stays; every later one covers its
    lines, and overlapping covered runs merge.  Windows are judged on the input.
    Windows of which every line is blank are not compared.

    Returns every column of ``docs`` (the text replaced) plus ``n_lines`` and
    ``n_removed``; columns of those names are replaced.  A text whose lines all go
    becomes empty, and its row stays.  Null text: stays null, 0 lines.  Texts with fewer
    lines than ``width`` stay whole.  Null ids order first.  Repeated rows
    (same id and text) count as one document and all get its result.  An empty
    table gives an empty result.
    """
    importable(docs.sparkSession)
    keep = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    k = width - 1
    others = [c for c in keep if c.lower() != text_col.lower()]
    rows = docs.select(F.struct(*[docs[c] for c in others]).alias("_row"), docs[id_col].alias("_id"), docs[text_col].alias("_text"), F.xxhash64(docs[text_col]).alias("_h"))
    # Lines become two hashes each before windows are made, so no text is carried along with a window.
    split = F.split("_text", "\n", -1)
    blank = lambda x: F.trim(F.translate(x, "\t\r", "  ")) == ""
    lines = rows.where("_text is not null").select("_id", "_h", F.transform(split, lambda x: F.struct(blank(x).alias("e"), F.xxhash64(x).alias("a"), F.xxhash64(F.lit(7), x).alias("b"))).alias("_l"))
    lines = lines.where(F.size("_l") >= width)

    def window(p):
        part = F.slice("_l", p + 1, width)
        return F.struct(p.alias("_p"), F.exists(part, lambda x: ~x["e"]).alias("_said"), F.xxhash64(F.transform(part, lambda x: x["a"])).alias("_a"), F.xxhash64(F.transform(part, lambda x: x["b"])).alias("_b"))

    windows = lines.select("_id", "_h", F.explode(F.transform(F.sequence(F.lit(0), F.size("_l") - width), window)).alias("_w")).select("_id", "_h", "_w.*").where("_said").drop("_said")
    windows = cut(windows)
    first = windows.groupBy("_a", "_b").agg(F.min(F.struct("_id", "_h", "_p")).alias("_f"), F.max(F.struct("_id", "_h", "_p")).alias("_z"), F.count("*").alias("_n")).where(~F.col("_f").eqNullSafe(F.col("_z"))).drop("_z")
    first = cut(first)
    repeats = first.agg(F.sum("_n")).first()[0] or 0
    later = spread_join(windows, first, ["_a", "_b"], "_n", repeats).where(~F.struct("_id", "_h", "_p").eqNullSafe(F.col("_f"))).select("_id", "_h", "_p")
    # a document's covered lines are bounded by its own length
    gone = later.groupBy("_id", "_h").agg(F.collect_set("_p").alias("_c")).select(F.col("_id").alias("_gid"), F.col("_h").alias("_gh"), F.array_distinct(F.flatten(F.transform("_c", lambda p: F.sequence(p, p + k)))).alias("_gone"))
    out = rows.join(gone, rows["_id"].eqNullSafe(gone["_gid"]) & rows["_h"].eqNullSafe(gone["_gh"]), "left")
    parts = F.split("_text", "\n", -1)
    kept = F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("_gone")), lambda i: F.get(parts, i)), "\n")
    text = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(kept)
    shown = [text.alias(c) if c.lower() == text_col.lower() else F.col("_row")[c].alias(c) for c in keep]
    return out.select(*shown, F.when(F.col("_text").isNull(), 0).otherwise(F.size(parts)).cast("bigint").alias("n_lines"), F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint").alias("n_removed"))


#: DuckDB SQL of the query; it compares the lines themselves.  Rows of one document are assumed not to repeat.
SQL = """
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, p, ls[p + 1 : p + 3] AS win FROM (SELECT doc_id, ls, unnest(range(0, len(ls) - 2)) AS p FROM l)),
ok AS (SELECT doc_id, p, win FROM w WHERE len(list_filter(win, lambda x: trim(translate(x, chr(9) || chr(13), '  ')) <> '')) > 0),
n AS (SELECT doc_id, p, row_number() OVER (PARTITION BY win ORDER BY doc_id, p) AS k FROM ok),
gone AS (SELECT DISTINCT doc_id, p + d AS p FROM n, (SELECT unnest([0, 1, 2]) AS d) WHERE k > 1),
e AS (SELECT doc_id, unnest(ls) AS line, unnest(range(0, len(ls))) AS p FROM l),
kept AS (SELECT e.doc_id, string_agg(e.line, chr(10) ORDER BY e.p) AS text, count(*) AS n FROM e ANTI JOIN gone USING (doc_id, p) GROUP BY e.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text,
       coalesce(len(l.ls), 0)::BIGINT AS n_lines, (coalesce(len(l.ls), 0) - coalesce(kept.n, 0))::BIGINT AS n_removed
FROM documents d LEFT JOIN l USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
