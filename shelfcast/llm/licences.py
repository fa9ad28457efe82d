"""Licence scan: sentences are mapped to known licence sentences, and their sequence to licences. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_IN_SENTENCES = "[^a-z0-9.;!?+]+"  # a run of these is one space
SENTENCE_END = "[.;!?]+( |$)"  # so a version number's dot does not end a sentence
KEYWORD = (
    "licen[cs]|copyright|rights reserved|warrant|permission|redistribut|spdx|public domain|liab|creative commons|cc by|cc0"
    "|endorse|modif"
)
#: The same for the text before normalisation.
KEYWORD_IN_TEXT = "(?i)" + KEYWORD.replace(" ", "[^a-z0-9]+")

# Wording of published licences and of the usual notices that name them, lower case, punctuation as spaces.
# The first rule that a sentence contains gives its identifier.
SENTENCES: list[tuple[str, str]] = [
    ("mit_grant", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit_notice", r"the above copyright notice and this permission notice shall be included in all"),
    ("isc_grant", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("as_is", r"software is provided as is "),
    ("no_liability", r"in no event shall .* be liable"),
    ("bsd_grant", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd_source", r"redistributions of source code must retain the above copyright notice"),
    ("bsd_binary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd_names", r"neither the names? of .* may be used to endorse or promote products"),
    ("apache2_may_not", r"you may not use this file except in compliance with the license"),
    ("apache2_copy", r"you may obtain a copy of the license at"),
    ("apache2_warranty", r"unless required by applicable law or agreed to in writing software distributed under the license"),
    ("apache2", r"apache (software )?license (version )?2(\.0)?\b"),
    ("agpl3", r"gnu affero general public license"),
    ("lgpl", r"gnu (lesser|library) general public license"),
    ("gpl3_later", r"(gnu general public license|version 3 of the license).*(or at your option any later version|or later)"),
    ("gpl2_later", r"version 2 of the license.*(or at your option any later version|or later)"),
    ("gpl3", r"gnu general public license (as published by the free software foundation )?(either )?(version|v) ?3|version 3 of the gnu general public license|\bgplv3\b"),
    ("gpl2", r"gnu general public license (as published by the free software foundation )?(either )?(version|v) ?2|version 2 of the gnu general public license|\bgplv2\b"),
    ("gpl", r"gnu general public license"),
    ("mpl2", r"mozilla public license (v\.? ?|version )?2\.0"),
    ("epl", r"eclipse public license"),
    ("eupl", r"european union public licen[cs]e"),
    ("cddl", r"common development and distribution license"),
    ("artistic", r"\bartistic license\b"),
    ("mit", r"\bmit license\b|licensed under (the )?mit\b"),
    ("bsd3", r"\b(3 clause bsd|bsd 3 clause|new bsd|modified bsd|revised bsd)\b"),
    ("bsd2", r"\b(2 clause bsd|bsd 2 clause|simplified bsd|freebsd license)\b"),
    ("bsd", r"\bbsd (style )?license\b"),
    ("isc", r"\bisc license\b"),
    ("zlib", r"\bzlib license\b"),
    ("boost", r"boost software license"),
    ("unlicense", r"\bunlicense\b|free and unencumbered software released into the public domain"),
    ("cc0", r"\bcc0\b|creative commons zero"),
    ("cc_by_nc_nd", r"\bcc by nc nd\b|creative commons attribution noncommercial noderiv"),
    ("cc_by_nc_sa", r"\bcc by nc sa\b|creative commons attribution noncommercial sharealike"),
    ("cc_by_nc", r"\bcc by nc\b|creative commons attribution noncommercial"),
    ("cc_by_nd", r"\bcc by nd\b|creative commons attribution noderiv"),
    ("cc_by_sa", r"\bcc by sa\b|creative commons attribution share ?alike"),
    ("cc_by", r"\bcc by\b|creative commons attribution"),
    ("public_domain", r"(in|into|to) the public domain"),
    ("all_rights", r"all rights reserved"),
    ("some_licence", r"(licensed|released|distributed|available|used) under (the |a |an )?.*licen[cs]e|licensed under (the )?terms"),
]

#: Families and versions of the GNU licences that have identifiers of their own, each for itself or with later versions.
GNU = [("gpl", "2.0"), ("gpl", "3.0"), ("lgpl", "2.0"), ("lgpl", "2.1"), ("lgpl", "3.0"), ("agpl", "3.0")]


def _gnu_id(family: str, version: str, later: str) -> str:
    name = f"{family}{version.removesuffix('.0').replace('.', '')}"
    return "agpl3" if (family, later) == ("agpl", "") else f"spdx_{name}{'_later' if later else ''}"


# Licences by the sequence of sentence identifiers, each followed by a space. Rules are tried in this order; what a rule
# has matched is taken out, so a full text is not also reported by one of its sentences.
RULES: list[tuple[str, str]] = [
    ("MIT", r"(mit )?mit_grant (mit_notice )?(as_is )?(no_liability )?"),
    ("ISC", r"(isc )?isc_grant (as_is )?(no_liability )?"),
    ("BSD-3-Clause", r"(bsd3? )?bsd_grant bsd_source bsd_binary bsd_names (as_is )?(no_liability )?"),
    ("BSD-2-Clause", r"(bsd2? )?bsd_grant bsd_source bsd_binary (as_is )?(no_liability )?"),
    ("Apache-2.0", r"(apache2 )?apache2_may_not (apache2_copy )?(apache2_warranty )?"),
    ("Apache-2.0", r"(apache2|spdx_apache2) (apache2_warranty )?"),
    ("MIT", r"\b(mit|spdx_mit) "),
    *[(f"{family.upper()}-{version}{later}", rf"\b{_gnu_id(family, version, later)} ")
      for family, version in GNU for later in ("-or-later", "") if (family, later) not in (("agpl", ""), ("gpl", ""))],
    ("AGPL-3.0", r"\bagpl3 "),
    ("LGPL", r"\blgpl "),
    ("GPL-3.0-or-later", r"(gpl )?gpl3_later "),
    ("GPL-2.0-or-later", r"(gpl )?gpl2_later "),
    ("GPL-3.0", r"\b(gpl3|spdx_gpl3) "),
    ("GPL-2.0", r"\b(gpl2|spdx_gpl2) "),
    ("GPL", r"\bgpl "),
    ("BSD-3-Clause", r"\b(bsd3|spdx_bsd3) "),
    ("BSD-2-Clause", r"\b(bsd2|spdx_bsd2) "),
    ("BSD", r"\b(bsd|bsd_grant) "),
    ("EUPL", r"\beupl "),
    ("CDDL", r"\bcddl "),
    ("Artistic", r"\bartistic "),
    ("MPL-2.0", r"\b(mpl2|spdx_mpl2) "),
    ("EPL", r"\bepl "),
    ("ISC", r"\b(isc|spdx_isc) "),
    ("Zlib", r"\bzlib "),
    ("BSL-1.0", r"\bboost "),
    ("Unlicense", r"\bunlicense (public_domain )?"),
    ("CC0", r"\bcc0 (public_domain )?"),
    ("CC-BY-NC-ND", r"\bcc_by_nc_nd "),
    ("CC-BY-NC-SA", r"\bcc_by_nc_sa "),
    ("CC-BY-NC", r"\bcc_by_nc "),
    ("CC-BY-ND", r"\bcc_by_nd "),
    ("CC-BY-SA", r"\bcc_by_sa "),
    ("CC-BY", r"\bcc_by "),
    ("Public-Domain", r"\bpublic_domain "),
    ("All-Rights-Reserved", r"\ball_rights "),
    ("Unknown", r"\bsome_licence "),
]


#: SPDX identifiers, each as a whole: the tag's identifier is followed by a sign that is in no other place. NONE and NOASSERTION
#: name no licence, and what is not listed is hinted at only.
SPDX: list[tuple[str, str]] = [
    ("", "none|noassertion"),
    ("spdx_mit", "mit"),
    ("spdx_apache2", r"apache 2\.0"),
    *[(_gnu_id(family, version, later), family + " " + version.replace(".", r"\.") + ("( or later|[+])" if later else "( only)?"))
      for family, version in GNU for later in ("", "-or-later")],
    ("spdx_bsd3", "bsd 3 clause"),
    ("spdx_bsd2", "bsd 2 clause"),
    ("spdx_mpl2", r"mpl 2\.0"),
    ("spdx_isc", "isc"),
    ("epl", r"epl [12]\.0"),
    ("eupl", r"eupl 1\.[0-2]"),
    ("cddl", r"cddl 1\.[01]"),
    ("artistic", r"artistic [12]\.0"),
    ("zlib", "zlib"),
    ("boost", r"bsl 1\.0"),
    ("unlicense", "unlicense"),
    ("cc0", r"cc0 1\.0"),
    *[(name, name.replace("_", " ") + r" [1-4]\.[05]") for name in
      ("cc_by_nc_nd", "cc_by_nc_sa", "cc_by_nc", "cc_by_nd", "cc_by_sa", "cc_by")],
    ("some_licence", "[a-z0-9.+ ]+"),
]

#: An identifier ends with a letter, a digit or a plus sign; a full stop after it ends the sentence.
SPDX_WHOLE = r"(?i)(spdx-license-identifier[ \t:(]*[a-z0-9.+-]*[a-z0-9+])"
#: An SPDX tag begins a sentence of its own, and so does each further identifier of its expression.
SPDX_TAG = r"(?i)[\r\n][^a-zA-Z0-9\r\n]*spdx-license-identifier"
SPDX_END = r"(?i)(spdx-license-identifier[^\r\n]*)[\r\n]"
SPDX_OPERATOR = (
    r"((?i:spdx-license-identifier)[ \t:(]*[A-Za-z0-9.+-]+|\G(?<!\A))((?:[ \t]+(?:WITH|with)[ \t]+[A-Za-z0-9.+-]+)?)"
    r"[ \t)]+(?:OR|AND|(?:or|and)(?=[ \t(]+[A-Z0-9]))[ \t(]+([A-Za-z0-9.+-]+)"
)

#: These reach over other words, or stand for a licence that others name better: they come after all others.
LAST = ("gpl3_later", "gpl2_later", "gpl3", "gpl2", "gpl")
HINT = "some_licence"


def _ordered() -> list[tuple[str, str]]:
    named = [(name, rf"spdx license identifier ({pattern}) [+] ") for name, pattern in SPDX]
    prose = [r for r in SENTENCES if r[0] != HINT]
    return named + [r for r in prose if r[0] not in LAST] + [r for r in prose if r[0] in LAST]


def _mark(name: str) -> str:
    return f"<{name.upper()}> " if name else ""


def sentence_ids(text: Column) -> Column:
    """The identifiers of the known sentences of a text, in order: all that a sentence contains, each once, by position.

    Of overlapping ones the more specific counts; a hint counts in sentences that name nothing else.
    """
    tags = F.regexp_replace(F.regexp_replace(text, SPDX_TAG, " . SPDX-License-Identifier"), SPDX_END, "$1 . ")
    tags = F.regexp_replace(tags, SPDX_OPERATOR, "$1$2 . SPDX-License-Identifier: $3")
    tags = F.regexp_replace(tags, SPDX_WHOLE, "$1 + ")
    spelled = F.when(F.contains(F.translate(text, UPPER, LOWER), F.lit("spdx")), tags).otherwise(text)
    normal = F.regexp_replace(F.concat(F.translate(spelled, UPPER, LOWER), F.lit(" ")), NOT_IN_SENTENCES, " ")
    sentences = F.filter(F.split(normal, SENTENCE_END, -1), lambda s: s.rlike(KEYWORD))

    def identifiers(sentence: Column) -> Column:
        # What a pattern has matched becomes its name in capitals, which no later pattern can match or reach over.
        for name, pattern in _ordered():
            sentence = F.regexp_replace(sentence, pattern.replace(".*", "[^<>]*"), _mark(name))
        found = F.array_distinct(F.regexp_extract_all(sentence, F.lit("<([A-Z0-9_]+)>"), F.lit(1)))
        hint = F.array(F.lit(HINT.upper()))
        return F.when(F.size(found) > 0, found).when(sentence.rlike(dict(SENTENCES)[HINT]), hint).otherwise(F.slice(hint, 1, 0))

    known = F.transform(F.flatten(F.transform(sentences, identifiers)), F.lower)
    return F.when(text.rlike(KEYWORD_IN_TEXT), known).otherwise(F.array().cast("array<string>"))


def licences_of(ids: Column) -> Column:
    """The licences whose rules the sequence of sentence identifiers meets, in the order of the rules, each once."""
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(rule).alias("rule")) for name, rule in RULES])
    sequence = F.concat(F.array_join(ids, " "), F.lit(" "))
    start = F.struct(sequence.alias("rest"), F.array().cast("array<string>").alias("found"))
    found = F.aggregate(
        rules,
        start,
        lambda acc, r: F.struct(
            F.regexp_replace(acc["rest"], r["rule"], "").alias("rest"),
            F.when(F.rlike(acc["rest"], r["rule"]), F.concat(acc["found"], F.array(r["name"])))
            .otherwise(acc["found"])
            .alias("found"),
        ),
        lambda acc: F.array_distinct(acc["found"]),
    )
    return F.when(F.size(ids) > 0, found).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, column: str = "text") -> DataFrame:
    """``docs`` with ``sentence_ids`` and ``licences`` (arrays of strings); input columns of these names are replaced.

    Null and empty texts have none. Rows are independent: no shuffle, equal rows give equal results, an empty table no
    rows. A sentence may run over lines, but an SPDX tag is one of its own; comment signs and other punctuation don't matter. A
    sentence may name several licences. A licence that is only hinted at, such as an SPDX identifier not listed, is ``Unknown``.
    """
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return docs.withColumn("sentence_ids", sentence_ids(text)).withColumn("licences", licences_of(F.col("sentence_ids")))


def op8_licences(spark: SparkSession, root: str) -> DataFrame:
    found = scan(table(spark, root, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licences", ",").alias("licences"),
        F.size("licences").cast("long").alias("n_licences"),
    )


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


#: For SQL, whose patterns cannot go on where the last match ended: one operator of each expression per pass.
_ID = "[A-Za-z0-9.+-]"
_SQL_OPERATOR = (
    rf"((?i:spdx-license-identifier)[ \t:(]*{_ID}+(?:[ \t]+(?:WITH|with)[ \t]+{_ID}+)?)[ \t)]+"
    rf"(?:(?:OR|AND)[ \t(]+({_ID}+)|(?:or|and)[ \t(]+([A-Z0-9]{_ID}*))"
)
SQL_OPERATORS = 8  # of one expression


def _oracle() -> str:
    def replaced(value: str, pattern: str, by: str) -> str:
        return f"regexp_replace({value}, {_quoted(pattern)}, {_quoted(by)}, 'g')"

    spelled = replaced(replaced("text", SPDX_TAG, " . SPDX-License-Identifier"), SPDX_END, r"\1 . ")
    for _ in range(SQL_OPERATORS):
        spelled = replaced(spelled, _SQL_OPERATOR, r"\1 . SPDX-License-Identifier: \2\3")
    spelled = replaced(spelled, SPDX_WHOLE, r"\1 + ")
    marked, marks = "marks0", []
    for i, (name, pattern) in enumerate(_ordered(), 1):
        marks.append(f"marks{i} AS (SELECT r, p, whole, {replaced('s', pattern.replace('.*', '[^<>]*'), _mark(name))} AS s FROM {marked})")
        marked = f"marks{i}"
    steps, last = [], "steps0"
    for i, (name, rule) in enumerate(RULES, 1):
        steps.append(
            f"steps{i} AS (SELECT r, doc_id, ids, {replaced('rest', rule, '')} AS rest,"
            f" CASE WHEN regexp_matches(rest, {_quoted(rule)}) AND NOT list_contains(found, '{name}')"
            f" THEN list_append(found, '{name}') ELSE found END AS found FROM {last})"
        )
        last = f"steps{i}"
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), spelled AS (
  SELECT r, translate(CASE WHEN contains(lower(text), 'spdx') THEN {spelled} ELSE text END, '{UPPER}', '{LOWER}') || ' ' AS s
  FROM docs WHERE regexp_matches(text, {_quoted(KEYWORD_IN_TEXT)})
), split AS (
  SELECT r, string_split_regex(regexp_replace(s, '{NOT_IN_SENTENCES}', ' ', 'g'), '{SENTENCE_END}') AS parts FROM spelled
), sentences AS (
  SELECT r, unnest(parts) AS s, generate_subscripts(parts, 1) AS p FROM split
), marks0 AS MATERIALIZED (
  SELECT r, p, s AS whole, s FROM sentences WHERE regexp_matches(s, '{KEYWORD}')
), {", ".join(marks)}, named AS (
  SELECT r, p, s, regexp_extract_all(s, '<([A-Z0-9_]+)>', 1) AS names FROM {marked}
), known AS (
  SELECT r, p, CASE WHEN len(names) > 0 THEN [n FOR n, i IN names IF list_position(names, n) = i]
                    WHEN regexp_matches(s, {_quoted(dict(SENTENCES)[HINT])}) THEN ['{HINT.upper()}'] ELSE [] END AS names
  FROM named
), found AS (
  SELECT r, flatten(list(names ORDER BY p)) AS names FROM known GROUP BY r
), steps0 AS (
  SELECT docs.r, doc_id, [lower(n) FOR n IN coalesce(names, [])] AS ids,
         lower(array_to_string(coalesce(names, []), ' ')) || ' ' AS rest, []::VARCHAR[] AS found
  FROM docs LEFT JOIN found USING (r)
), {", ".join(steps)}
SELECT doc_id, array_to_string(ids, ',') AS sentence_ids, array_to_string(found, ',') AS licences,
       len(found)::BIGINT AS n_licences FROM {last}
"""


OP8_SQL = _oracle()
