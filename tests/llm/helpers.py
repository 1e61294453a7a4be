"""Small tables with what can go wrong in a row."""

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, score double, node bigint, "
          "spans string, Key string, near_row int, leak_key int, toxicity_score string, size int")


def documents(spark, rows):
    """rows: (doc_id, text[, source]); the other columns bear names that operators use inside."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None, 1.5, 7, "x", "k", 3, 4, "t", 5) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def values(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)
