"""The queries of this subpackage, and the SQL that some must match."""

from __future__ import annotations

from panelweave.llm import (
    collocations, host_quality, line_runs, mixing, near_duplicates, packing, posting_lists, shingle_join, surrogates, token_counts, token_files,
    url_rules, whitening,
)
from panelweave.llm.shared import table


def op1_host_quality(spark, folder):
    return host_quality.digest(table(spark, folder, "documents"))


def op2_simhash(spark, folder):
    return near_duplicates.digest(table(spark, folder, "documents"))


def op3_url_rules(spark, folder):
    return url_rules.digest(table(spark, folder, "pages"), table(spark, folder, "labels"))


def op4_packing(spark, folder):
    return packing.packed(table(spark, folder, "documents"))


def op5_surrogates(spark, folder):
    return surrogates.digest(table(spark, folder, "documents"))


def op6_line_runs(spark, folder):
    return line_runs.digest(table(spark, folder, "documents"))


def op7_token_counts(spark, folder):
    return token_counts.digest(table(spark, folder, "documents"))


def op8_mixing(spark, folder):
    return mixing.digest(table(spark, folder, "documents"))


def op9_token_files(spark, folder):
    return token_files.digest(table(spark, folder, "documents"))


def op10_posting_lists(spark, folder):
    return posting_lists.nearest(table(spark, folder, "embeddings"))


def op11_shingle_join(spark, folder):
    return shingle_join.digest(table(spark, folder, "documents"))


def op12_whitening(spark, folder):
    return whitening.digest(table(spark, folder, "embeddings"))


def op13_collocations(spark, folder):
    return collocations.digest(table(spark, folder, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_host_quality, op2_simhash, op3_url_rules, op4_packing, op5_surrogates, op6_line_runs, op7_token_counts,
        op8_mixing, op9_token_files, op10_posting_lists, op11_shingle_join, op12_whitening, op13_collocations,
    )
}
SQL = {
    "op1_host_quality": host_quality.SQL, "op3_url_rules": url_rules.SQL, "op4_packing": packing.SQL, "op6_line_runs": line_runs.SQL,
    "op11_shingle_join": shingle_join.SQL, "op13_collocations": collocations.SQL,
}
