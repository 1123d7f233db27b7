"""Small hand-written inputs and ways to look at plans."""

import contextlib
import io


def rows(df, *columns):
    """Collected rows as sorted tuples."""
    selected = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in selected.collect()), key=repr)


def plan_text(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def long_counts(spark, cells):
    """Long counts from (gene, sample, hours, count); the sample's replicate is its last letter."""
    data = [(g, s, h, h, s[-1], c) for g, s, h, c in cells]
    schema = (
        "gene_id string, sample_id string, hours int, time_point int, replicate string, "
        "raw_count bigint"
    )
    return spark.createDataFrame(data, schema)


def leveled(spark, cells):
    """Normalised rows from (gene, sample, hours, log2_cpm)."""
    data = [(g, s, h, h, s[-1], v) for g, s, h, v in cells]
    schema = (
        "gene_id string, sample_id string, hours int, time_point int, replicate string, "
        "log2_cpm double"
    )
    return spark.createDataFrame(data, schema)
