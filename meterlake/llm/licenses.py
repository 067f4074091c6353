"""License scan with a positional index of rare words.

Every template is indexed by the two rarest words of its key phrase, rarity being the inverse
document frequency in the scanned corpus. A file's words are looked up in the order of that
rarity; where both rare words stand at the distance that the template gives them, the place is
a candidate, and it counts only if the mandatory key phrase stands there in full. The share of
the template's words found at their places is the score.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from meterlake.llm.common import text_of

# Fixed values: (label, words of the template, mandatory key phrase), base phrases first.
BASE = (
    ("mit", "under the mit license", "under the mit license"),
    ("apache-2", "apache license version 2", "apache license version 2"),
    ("cc-by-nc", "cc by nc", "cc by nc"),
)
OTHER = (
    ("gpl-3", "licensed under the gnu general public license version 3",
     "gnu general public license version 3"),
    ("gpl-2", "licensed under the gnu general public license version 2",
     "gnu general public license version 2"),
    ("lgpl", "under the gnu lesser general public license", "gnu lesser general public license"),
    ("agpl-3", "under the gnu affero general public license version 3",
     "gnu affero general public license"),
    ("mpl-2", "subject to the terms of the mozilla public license version 2 0",
     "mozilla public license"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy",
     "permission is hereby granted free of charge"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
     "permitted", "redistribution and use in source and binary forms"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with "
     "or without fee is hereby granted", "permission to use copy modify and or distribute"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "free and unencumbered software"),
    ("cc-by-sa", "licensed under cc by sa", "cc by sa"),
    ("cc0", "cc0 1 0 universal", "cc0 1 0"),
)

# Everything ASCII but digits and letters; capitals are lowered first.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RARE_WORDS = 2


@dataclass(frozen=True)
class Template:
    label: str
    base: bool
    words: tuple[str, ...]
    key: tuple[str, ...]

    @property
    def key_at(self) -> int:
        return next(
            i
            for i in range(len(self.words))
            if self.words[i : i + len(self.key)] == self.key
        )


TEMPLATES = tuple(
    Template(label, table is BASE, tuple(words.split()), tuple(key.split()))
    for table in (BASE, OTHER)
    for label, words, key in table
)


def words_of(text: Column) -> Column:
    """Words of a text. The Kelvin sign is the one other character that lowers to an ASCII
    letter, so it is replaced by another letter-like sign before lowering."""
    plain = F.lower(F.replace(text, F.lit("\u212a"), F.lit("\u212b")))
    return F.array_remove(F.split(plain, SEPARATOR), "")


def tokenized(docs: DataFrame) -> DataFrame:
    """`doc_id, words`. The generator keeps Spark from splitting once per use of the words."""
    return docs.select("doc_id", F.explode(F.array(words_of(text_of()))).alias("words"))


def rarest_first(files: DataFrame, templates: tuple[Template, ...]) -> list[str]:
    """The words of all key phrases, fewest documents first, counted over every document.

    The driver gets one number for each of these words, whatever the corpus.
    """
    vocabulary = sorted({word for template in templates for word in template.key})
    known = F.array(*map(F.lit, vocabulary))
    counts = (
        files.select(F.explode(F.array_intersect(known, "words")).alias("word"))
        .groupBy("word")
        .count()
    )
    found = {row["word"]: row["count"] for row in counts.collect()}
    return sorted(vocabulary, key=lambda word: (found.get(word, 0), word))


def postings(templates: tuple[Template, ...], rarest: list[str]) -> Column:
    """The index as a constant: each template with its rare words and their places."""

    def entry(template: Template) -> Column:
        rare = sorted(set(template.key), key=rarest.index)[:RARE_WORDS]
        first, second = rare[0], rare[-1]
        return F.struct(
            F.lit(template.label).alias("label"),
            F.lit(template.base).alias("base"),
            F.lit(first).alias("first"),
            F.lit(template.key.index(first)).alias("first_at"),
            F.lit(second).alias("second"),
            F.lit(template.key.index(second)).alias("second_at"),
            F.array(*map(F.lit, template.words)).alias("words"),
            F.array(*map(F.lit, template.key)).alias("key"),
            F.lit(template.key_at).alias("key_at"),
        )

    return F.array(*map(entry, templates))


def places(index: Column, rarest: list[str]) -> Column:
    """Array of `label, base, start, share` for every verified place of every template."""
    words = F.col("words")
    in_file = F.array_intersect(F.array(*map(F.lit, rarest)), words)

    def verified(t: Column) -> Column:
        everywhere = F.sequence(F.lit(0), F.size(words) - 1)
        hits = F.filter(everywhere, lambda i: F.get(words, i) == t["first"])
        starts = F.transform(hits, lambda i: i - t["first_at"])
        agreeing = F.filter(
            starts, lambda s: (s >= 0) & (F.get(words, s + t["second_at"]) == t["second"])
        )
        exact = F.filter(agreeing, lambda s: F.slice(words, s + 1, F.size(t["key"])) == t["key"])

        def share(s: Column) -> Column:
            met = F.filter(
                F.transform(
                    t["words"], lambda word, i: F.get(words, s - t["key_at"] + i).eqNullSafe(word)
                ),
                lambda same: same,
            )
            return F.size(met) / F.size(t["words"])

        return F.transform(
            exact,
            lambda s: F.struct(
                t["label"].alias("label"), t["base"].alias("base"), s.alias("start"),
                share(s).alias("share"),
            ),
        )

    looked_up = F.filter(
        index,
        lambda t: F.array_contains("__rare", t["first"]) & F.array_contains("__rare", t["second"]),
    )
    return in_file, F.flatten(F.transform(looked_up, verified))


def license_scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """`doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`.

    Null and empty texts have no words, no labels and score 0. Every place counts, also
    overlapping ones. The score is the best share of a template found at its places, 1 for a
    base phrase. One row per row of `docs`; other columns are ignored.
    """
    files = tokenized(docs)
    rarest = rarest_first(files, templates)
    in_file, found = places(postings(templates, rarest), rarest)
    scanned = (
        files.withColumn("__rare", in_file)
        .select("doc_id", F.size("words").alias("n_words"), F.explode(F.array(found)).alias("all"))
        .withColumn("base", F.filter("all", lambda p: p["base"]))
    )
    starts = F.transform("base", lambda p: p["start"].cast("long"))
    return scanned.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined("base").alias("base_labels"),
        joined("all").alias("labels"),
        F.coalesce(F.array_max(F.transform("all", lambda p: p["share"])), F.lit(0.0)).alias("score"),
    )


def joined(found: str) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda p: p["label"]))), ",")


def oracle_sql(templates: tuple[Template, ...] = TEMPLATES) -> str:
    """Every template tried at every word."""

    def row(t: Template) -> str:
        words, key = (", ".join(f"'{word}'" for word in part) for part in (t.words, t.key))
        return f"('{t.label}', {str(t.base).lower()}, [{words}], [{key}], {t.key_at})"

    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH templates(label, base, words, key, key_at) AS (VALUES {", ".join(map(row, templates))}),
files AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), '{upper}', '{lower}'), '{SEPARATOR}'), lambda x: x <> '') AS w
  FROM documents),
tokens AS (SELECT doc_id, w, unnest(range(0, len(w))) AS s FROM files),
places AS (
  SELECT doc_id, label, base, s,
    len(list_filter(range(0, len(words)),
      lambda i: s - key_at + i >= 0 AND coalesce(w[s - key_at + i + 1] = words[i + 1], false)))
      / len(words) AS share
  FROM tokens JOIN templates ON w[s + 1] = key[1] AND w[s + 1 : s + len(key)] = key),
found AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(s) FILTER (base) AS first_word,
    max(s) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM places GROUP BY doc_id)
SELECT f.doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0.0) AS score
FROM files AS f LEFT JOIN found USING (doc_id)
"""
