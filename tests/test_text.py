import pytest
from pyspark.sql import functions as F

from mdcatalog.functions import frontmatter as fm
from mdcatalog.functions import markdown as md
from mdcatalog.functions import paths as pt
from mdcatalog.functions import text as tx


def rows(spark, expression, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("s"))).collect()]


def test_trim_and_cells(spark):
    assert rows(spark, tx.trim_ws, ["\t a \n", " x　", "  ", None]) == ["a", "x", "", None]
    assert rows(spark, tx.sanitize_cell, ["a|b\r\nc\rd\ne "]) == ["a\\|b c d e"]
    assert rows(spark, tx.slugify, [" Get /Orders/{id} ", "--"]) == ["get-orders-id", ""]
    assert rows(spark, tx.strip_credentials, ["mongodb://u:p@h:1/db", "mongodb://h/db"]) == ["mongodb://h:1/db", "mongodb://h/db"]
    assert rows(spark, tx.strip_engine_noise, ["Users; InnoDB free: 4 kB", "InnoDB free: 1 kB", " a "]) == ["Users", "", "a"]


def test_placeholders(spark):
    texts = ["", "  ", None, "SQLite table orders", "File config.yaml", "No description available", "GraphQL type X",
             "One row per SQLite table x", "Filename list", "GraphQL enum X", "MySQL table "]
    assert rows(spark, tx.is_placeholder, texts) == [True] * 7 + [False] * 4


def test_structural_hash_ignores_line_ends_and_trailing_blanks(spark):
    a, b, c = rows(spark, tx.structural_hash, ["x  \r\ny\t\r\n\r\n", "x\ny", "x\n y"])
    assert a == b != c
    import hashlib
    assert b == hashlib.sha256(b"x\ny\n").hexdigest()


def test_numbers_and_dates(spark):
    assert rows(spark, tx.is_int64, ["1", "-7", "+5", "9223372036854775808", "1.0", ""]) == [True, True, True, False, False, False]
    assert rows(spark, tx.is_float64, ["1.5", ".5", "5.", "1e3", "NaN", "-Inf", "0x1p-2", "1e999", "1,5", "x"]) == [True] * 7 + [False] * 3
    dates = ["2024-01-02", "2024-02-30", "2024-01-02T03:04:05Z", "2024-01-02T03:04:05.5+02:00", "2024-01-02 03:04:05", "2024-01-02 25:00:00", "2024-01-02T03:04:05"]
    assert rows(spark, tx.is_iso_date, dates) == [True, False, True, True, True, False, False]


def loop_score(q, text):
    q, text = q.lower(), text.lower()
    at = score = streak = 0
    first = -1
    for ch in q:
        i = text.find(ch, at)
        if i < 0:
            return -1
        first = i if first < 0 else first
        streak = streak + 1 if i == at else 0
        score += 5 + streak if i == at else 1
        at = i + 1
    return score + (10 if first == 0 and q else 0)


@pytest.mark.parametrize("query", ["ord", "tb", "", "zz", "o r"])
def test_fuzzy_score_equals_loop(spark, query):
    names = ["tables/orders Orders", "orders", "the border", "tab", "", "ORDERS r"]
    assert rows(spark, lambda c: tx.fuzzy_score(query, c), names) == [loop_score(query, n) for n in names]


def test_paths(spark):
    assert rows(spark, pt.clean_path, ["a/./b/../c", "../x", "a//b", "a/../..", "/../x", "plain/path", "a/b/"]) == [
        "a/c", "../x", "a/b", "..", "/x", "plain/path", "a/b"]
    assert rows(spark, pt.ancestors, ["a/b/c", "x"]) == [["a", "a/b"], []]
    assert rows(spark, pt.parent_dir, ["a/b/c", "x"]) == ["a/b", ""]
    assert rows(spark, pt.csv_concept_path, ["sub/orders.csv"]) == ["tables/sub/orders.md"]
    assert rows(spark, pt.csv_asset_path, ["tables/sub/orders.md"]) == ["sub/orders.csv"]


def test_resolve_link(spark):
    targets = ["/tables/c.md", "../x.md", "c.md#part", "c.md?v=1", "https://e.org/c.md", "mailto:a@b.md", "c.txt", "#top", "./sub/../c.md", "../../up.md"]
    assert rows(spark, lambda t: pt.resolve_link(F.lit("tables/orders"), t), targets) == [
        "tables/c", "x", "tables/c", "tables/c", "", "", "", "", "tables/c", "../up"]


BODY = "# Columns\n\n| a |\n\n## Sample\n\nold\n\n### deeper\nkept\n\n# Notes\n\ntext\n"


def test_sections(spark, one):
    body = F.col("b")
    assert one(md.get_section(body, "Sample"), b=BODY) == "old\n\n### deeper\nkept"
    assert one(md.get_section(body, "Columns"), b=BODY) is None
    assert one(md.get_section(body, "Columns", any_level=True), b=BODY) == "| a |"
    assert one(md.get_section(body, "deeper", any_level=True), b=BODY) == "kept"
    assert one(md.get_section(body, "Sample"), b="#Sample\nx") is None
    assert one(md.headings(body), b=BODY) == ["Columns", "Sample", "Notes"]
    assert one(md.first_heading(body), b="x\n  ## Title here\n# Other") == "Title here"


def test_upsert_section(one):
    body = F.col("b")
    replaced = one(md.upsert_section(body, "Sample", F.lit("new\n\n")), b=BODY)
    assert replaced == "# Columns\n\n| a |\n\n## Sample\n\nnew\n\n# Notes\n\ntext\n"
    assert one(md.upsert_section(body, "Stats", F.lit("s")), b=BODY) == BODY + "\n## Stats\n\ns\n"
    assert one(md.upsert_section(body, "Stats", F.lit("s")), b="") == "## Stats\n\ns\n"
    assert one(md.upsert_section(body, "Sample", F.lit("n")), b="## Sample\n\nx") == "## Sample\n\nn\n"
    again = one(md.upsert_section(body, "Sample", F.lit("new\n\n")), b=replaced)
    assert again == replaced


def test_append_section(one):
    assert one(md.append_section(F.col("b"), "Links", F.lit("- x\n")), b="a\n\n") == "a\n\n# Links\n\n- x\n"
    assert one(md.append_section(F.col("b"), "Links", F.lit("")), b="a\n\n") == "a\n\n"


def test_cells(one):
    assert one(md.split_cells(F.col("r")), r="| a \\| b | | c ||") == ["a \\| b", "", "c", ""]
    assert one(md.is_divider(F.col("c")), c=["---", ":-:"]) is True
    assert one(md.is_divider(F.col("c")), c=["---", "a---"]) is False


def test_frontmatter_split(one):
    raw = F.col("r")
    assert one(fm.body(raw), r="---\na: 1\n---\nrest\n---\nmore") == "rest\n---\nmore"
    assert one(fm.block(raw), r="---\r\na: 1\r\n---\r\nrest") == "a: 1\n"
    assert one(fm.body(raw), r="---\r\na: 1\r\n---\r\nrest") == "rest"
    assert one(fm.has_block(raw), r="text\n---\n---\n") is False
    assert one(fm.has_block(raw), r="---\n---\nx") is True
    assert one(fm.body(raw), r="---\n---\nx") == "x"
