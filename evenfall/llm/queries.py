"""Queries of the training-data operators, by name. Each takes (spark, sf_dir)."""

from __future__ import annotations

from evenfall.llm import addresses, boilerplate, mixing, neardup, packing, quality, residue, tags
from evenfall.runtime import table


def p1_found(spark, sf_dir):
    return addresses.same_addresses(table(spark, sf_dir, "venue_seeds"), table(spark, sf_dir, "event_items"))


def p3_found(spark, sf_dir):
    return tags.mapped_tags(table(spark, sf_dir, "event_items"), table(spark, sf_dir, "tags"))


def p5_found(spark, sf_dir):
    return boilerplate.boilerplate(table(spark, sf_dir, "cases"), table(spark, sf_dir, "event_items"))


def p6_found(spark, sf_dir):
    return residue.residue_fields(table(spark, sf_dir, "event_items"))


def p7_found(spark, sf_dir):
    return neardup.same_events(table(spark, sf_dir, "event_items"), table(spark, sf_dir, "sources"))


def p8_packed(spark, sf_dir):
    return packing.packed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pack_jobs"))


def p8_fill(spark, sf_dir):
    return packing.fills(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pack_jobs"))


def p8_faults(spark, sf_dir):
    return packing.faults(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pack_jobs"))


def p9_copies(spark, sf_dir):
    return mixing.copies(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p9_shares(spark, sf_dir):
    return mixing.shares(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p10_found(spark, sf_dir):
    return quality.not_prose(table(spark, sf_dir, "documents"), table(spark, sf_dir, "common_words"))


def p10_statistics(spark, sf_dir):
    """Language and the statistics that SQL can follow; sentence, garbled and single-letter shares stand in p10_all_statistics."""
    return quality.document_statistics(table(spark, sf_dir, "documents"), table(spark, sf_dir, "common_words")).select("doc_id", "language", "words", "mean_word_length", "symbol_ratio", "digit_ratio", "line_end_ratio", "common_ratio")


def p10_all_statistics(spark, sf_dir):
    return quality.document_statistics(table(spark, sf_dir, "documents"), table(spark, sf_dir, "common_words"))


QUERIES = {"p1_found": p1_found, "p3_found": p3_found, "p5_found": p5_found, "p6_found": p6_found, "p7_found": p7_found, "p8_packed": p8_packed, "p8_fill": p8_fill, "p8_faults": p8_faults, "p9_copies": p9_copies, "p9_shares": p9_shares, "p10_found": p10_found, "p10_statistics": p10_statistics, "p10_all_statistics": p10_all_statistics}

SQL: dict[str, str] = {
    "p10_statistics": r"""WITH c AS (SELECT list(DISTINCT lower(word)) AS common FROM common_words),
d AS (SELECT doc_id, coalesce(text, '') AS t, lower(substr(trim(lang), 1, 2)) AS two FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[\p{L}\p{Nl}\p{No}]+(?:[''’][\p{L}\p{Nl}\p{No}]+)*') AS words, length(regexp_replace(t, '[\s\p{Z}\x{0b}\x{1c}-\x{1f}\x{85}]', '', 'g')) AS solid, length(regexp_replace(t, '[^\p{Nd}]', '', 'g')) AS digits,
  list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, '[\s\p{Z}\x{0b}\x{1c}-\x{1f}\x{85}]', '', 'g') <> '') AS lines FROM d),
n AS (SELECT *, len(words) AS n, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS letters FROM w)
SELECT doc_id, CASE WHEN two IN ('en', 'de', 'es', 'fr') THEN two ELSE 'other' END AS language, n AS words, CASE WHEN n > 0 THEN letters / n ELSE 0.0 END AS mean_word_length, CASE WHEN solid > 0 THEN (solid - letters - digits) / solid ELSE 0.0 END AS symbol_ratio, CASE WHEN solid > 0 THEN digits / solid ELSE 0.0 END AS digit_ratio,
  CASE WHEN len(lines) > 0 THEN len(list_filter(lines, lambda x: regexp_matches(x, '[.!?…]["''”’)\]]*[\s\p{Z}\x{0b}\x{1c}-\x{1f}\x{85}]*$'))) / len(lines) ELSE 0.0 END AS line_end_ratio, CASE WHEN n > 0 THEN len(list_filter(words, lambda x: list_contains(common, lower(x)))) / n ELSE 0.0 END AS common_ratio FROM n, c""",
    "p8_faults": "SELECT job_name, (SELECT count(*) FROM documents) AS documents, 0 AS lost, 0 AS twice, 0 AS overfull, 0 AS misstated, 0 AS torn FROM pack_jobs WHERE capacity_tokens > 0 GROUP BY job_name",
}
