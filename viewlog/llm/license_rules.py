"""License scans by ordered signature rules.

A rule is a regular expression over the words of a text, keywords of which one must be present before
the expression is tried, a label and a priority. All matches of all rules are intervals of words; one
that lies inside another of the same or a higher priority is suppressed. The work is done inside the
row: no document is taken apart into rows and put together again.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewlog.llm.tables import let, text_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # of a lower-cased text
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Phrases that are always looked for, with their labels: fixed values.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Priorities, from a bare name to a machine-readable tag, and the confidence each gives.
BARE, NAMED, GRANTED, TAGGED = 1, 2, 3, 4
LEVELS = 4
CONFIDENCE = {BARE: 0.5, NAMED: 0.7, GRANTED: 0.9, TAGGED: 1.0}

# Families: label, the name as an expression, keywords one of which every match contains, versions, tag.
# In the words of a text "4.0" is "4 0" and "BSD-3-Clause" is "bsd 3 clause".
FAMILIES = (
    ("gpl", r"(?:gnu )?(?:general public licen[sc]e|gpl)", (" gpl", " general public "), ("1.0", "2.0", "3.0"), "gpl"),
    ("lgpl", r"(?:gnu )?(?:(?:lesser|library) general public licen[sc]e|lgpl)", (" lgpl", " lesser general ", " library general "), ("2.0", "2.1", "3.0"), "lgpl"),
    ("agpl", r"(?:gnu )?(?:affero general public licen[sc]e|agpl)", (" agpl", " affero "), ("1.0", "3.0"), "agpl"),
    ("gfdl", r"(?:gnu )?(?:free documentation licen[sc]e|gfdl)", (" gfdl", " free documentation "), ("1.1", "1.2", "1.3"), "gfdl"),
    ("apache", r"apache (?:software )?licen[sc]e", (" apache ",), ("1.0", "1.1", "2.0"), "apache"),
    ("mit", r"mit(?: x11)? licen[sc]e", (" mit ",), (), "mit"),
    ("x11", r"x11 licen[sc]e", (" x11 ",), (), "x11"),
    ("isc", r"isc licen[sc]e", (" isc ",), (), "isc"),
    ("zlib", r"zlib(?: libpng)? licen[sc]e", (" zlib ",), (), "zlib"),
    ("bsd-2-clause", r"(?:simplified bsd licen[sc]e|bsd 2 clause(?: licen[sc]e)?|2 clause bsd(?: licen[sc]e)?)", (" bsd ",), (), "bsd 2 clause"),
    ("bsd-3-clause", r"(?:(?:new|modified|revised) bsd licen[sc]e|bsd 3 clause(?: licen[sc]e)?|3 clause bsd(?: licen[sc]e)?)", (" bsd ",), (), "bsd 3 clause"),
    ("bsd-4-clause", r"(?:original bsd licen[sc]e|bsd 4 clause(?: licen[sc]e)?|4 clause bsd(?: licen[sc]e)?)", (" bsd ",), (), "bsd 4 clause"),
    ("bsd", r"bsd licen[sc]e", (" bsd ",), (), "bsd"),
    ("mpl", r"(?:mozilla public licen[sc]e|mpl)", (" mpl", " mozilla "), ("1.0", "1.1", "2.0"), "mpl"),
    ("epl", r"(?:eclipse public licen[sc]e|epl)", (" epl", " eclipse "), ("1.0", "2.0"), "epl"),
    ("cddl", r"(?:common development and distribution licen[sc]e|cddl)", (" cddl", " common development "), ("1.0", "1.1"), "cddl"),
    ("cpl", r"common public licen[sc]e", (" common public ",), ("1.0",), "cpl"),
    ("eupl", r"(?:european union public licen[sc]e|eupl)", (" eupl", " european union "), ("1.0", "1.1", "1.2"), "eupl"),
    ("artistic", r"artistic licen[sc]e", (" artistic ",), ("1.0", "2.0"), "artistic"),
    ("bsl", r"boost software licen[sc]e", (" boost ",), ("1.0",), "bsl"),
    ("python", r"(?:python software foundation|psf) licen[sc]e", (" python software ", " psf "), ("2.0",), "psf"),
    ("php", r"php licen[sc]e", (" php ",), ("3.0", "3.01"), "php"),
    ("ruby", r"ruby licen[sc]e", (" ruby ",), (), "ruby"),
    ("ofl", r"(?:sil )?open font licen[sc]e", (" open font ",), ("1.0", "1.1"), "ofl"),
    ("osl", r"open software licen[sc]e", (" open software ",), ("1.0", "2.0", "2.1", "3.0"), "osl"),
    ("afl", r"academic free licen[sc]e", (" academic free ",), ("1.1", "1.2", "2.0", "2.1", "3.0"), "afl"),
    ("ms-pl", r"microsoft public licen[sc]e", (" microsoft ",), (), "ms pl"),
    ("ms-rl", r"microsoft reciprocal licen[sc]e", (" microsoft ",), (), "ms rl"),
    ("wtfpl", r"(?:do what the fuck you want to public licen[sc]e|wtfpl)", (" wtfpl", " what the fuck "), ("1.0", "2.0"), "wtfpl"),
    ("unlicense", r"unlicen[sc]e", ("unlicen",), (), "unlicense"),
    ("vim", r"vim licen[sc]e", (" vim ",), (), "vim"),
    ("postgresql", r"postgresql licen[sc]e", (" postgresql ",), (), "postgresql"),
    ("openssl", r"openssl licen[sc]e", (" openssl ",), (), "openssl"),
    ("odbl", r"(?:open (?:data commons )?(?:open )?database licen[sc]e|odbl)", (" odbl", " database "), ("1.0",), "odbl"),
    ("odc-by", r"(?:open data commons attribution licen[sc]e|odc by)", (" odc by ", " open data commons "), ("1.0",), "odc by"),
    ("pddl", r"(?:public domain dedication and licen[sc]e|pddl)", (" pddl", " domain dedication "), ("1.0",), "pddl"),
    ("lppl", r"latex project public licen[sc]e", (" latex ",), ("1.0", "1.1", "1.2", "1.3"), "lppl"),
    ("ncsa", r"(?:university of illinois )?ncsa(?: open source)? licen[sc]e", (" ncsa ",), (), "ncsa"),
    ("upl", r"universal permissive licen[sc]e", (" universal ",), ("1.0",), "upl"),
    ("sspl", r"(?:server side public licen[sc]e|sspl)", (" sspl", " server side "), ("1.0",), "sspl"),
    ("elastic", r"elastic licen[sc]e", (" elastic ",), ("1.0", "2.0"), "elastic"),
    ("busl", r"business source licen[sc]e", (" business ",), ("1.0", "1.1"), "busl"),
    ("polyform-noncommercial", r"polyform noncommercial licen[sc]e", (" polyform ",), ("1.0",), "polyform noncommercial"),
    ("hippocratic", r"hippocratic licen[sc]e", (" hippocratic ",), ("1.0", "2.1", "3.0"), "hippocratic"),
    ("openrail", r"(?:creativeml )?open ?rail(?: m)?(?: licen[sc]e)?", ("rail",), (), "openrail"),
)

# The Creative Commons set: elements by label, with the long form of their names.
COMMONS = {
    "by": "attribution",
    "by-sa": "attribution share ?alike",
    "by-nd": "attribution no ?deriv(?:ative|ative work|ativework|ativ)?e?s?",
    "by-nc": "attribution non ?commercial",
    "by-nc-sa": "attribution non ?commercial share ?alike",
    "by-nc-nd": "attribution non ?commercial no ?deriv(?:ative|ative work|ativework|ativ)?e?s?",
}
COMMONS_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

# Statements that name no family.
STATEMENTS = (
    ("cc0", r"(?:cc0|cc zero)(?: 1 0)?(?: universal)?", (" cc0 ", " cc zero "), NAMED),
    ("public-domain", r"(?:placed in|released into|dedicated to|in) the public domain", (" public domain ",), GRANTED),
    ("public-domain", r"public domain", (" public domain ",), BARE),
    ("proprietary", r"all rights reserved", (" rights reserved ",), BARE),
    ("proprietary", r"proprietary and confidential", (" proprietary ",), NAMED),
    ("copyright", r"copyright (?:c )?(?:19|20)[0-9][0-9]", (" copyright ",), BARE),
    ("copyleft", r"copyleft", (" copyleft ",), BARE),
    ("unspecified", r"(?:licen[sc]ed|released|distributed) under (?:an? |the )?open source licen[sc]e", (" open source ",), NAMED),
    ("non-commercial", r"for non ?commercial use only", ("commercial use ",), NAMED),
    ("permissive", r"permission is hereby granted free of charge to any person", (" hereby granted ",), GRANTED),
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software", (" hereby granted ",), TAGGED),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose", (" permission to use ",), TAGGED),
    ("bsd", r"redistribution and use in source and binary forms with or without modification", (" redistribution ",), TAGGED),
)
GRANT = r"(?:licen[sc]ed|released|distributed|published|available|provided) under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?"
LICENSE_WORD = r"(?: (?:international |unported |public )?licen[sc]e)?"

# Parts of words one of which every text with a match contains, tried before anything else.
STEMS = ("licen", "apache", "gpl", "gfdl", "mpl", "epl", "cddl", "eupl", "wtfpl", "pddl", "odbl", "odc", "sspl", "rail", "spdx",
         "cc", "commons", "bsd", "public", "reserved", "proprietary", "copyright", "copyleft", "commercial",
         "permission", "redistribution")


def _version(version: str) -> str:
    """"2.0" as it may stand among words: "2 0", "2", "v2", "version 2 0"."""
    major, minor = version.split(".")
    tail = r"(?: 0)?" if minor == "0" else f" {minor}"
    return rf"(?:version |v ?)?{major}{tail}(?! [0-9])"


# Between a name and its version: a space, or nothing before "v" or after an acronym as in "GPL3".
JOINT = r"(?: |(?=v ?[0-9])|(?<=pl)(?=[0-9]))"
SHORT = ("apache",)  # families named without "license" too, if the whole version follows


def _forms(label: str, name: str, keywords: tuple[str, ...], versions: tuple[str, ...], tag: str) -> list[tuple]:
    """The rules of one family: named, granted and tagged, without and with each version."""
    rules = [
        (label, name, keywords, NAMED if " " in name else BARE),
        (label, GRANT + name, keywords, GRANTED),
        (label, rf"spdx licen[sc]e identifier {tag}(?: only| or later)?(?! [0-9])", (" spdx ",), TAGGED),
    ]
    for version in versions:
        number, own = _version(version), f"{label}-{version}"
        rules += [
            (own, rf"{name}{JOINT}{number}", keywords, GRANTED),
            (own, rf"{GRANT}{name}{JOINT}{number}(?: or (?:any )?later(?: version)?)?", keywords, TAGGED),
            (own, rf"spdx licen[sc]e identifier {tag} {number}(?: only| or later)?", (" spdx ",), TAGGED),
        ]
        if label in SHORT:
            whole = rf"{label} (?:version |v ?)?{version.replace('.', ' ')}(?! [0-9])"
            rules += [(own, whole, keywords, NAMED), (own, GRANT + whole, keywords, GRANTED)]
    return rules


def rules() -> list[dict]:
    """All rules in order: label, expression, keywords, priority."""
    found: list[tuple] = []
    for family in FAMILIES:
        found += _forms(*family)
    for elements, long in COMMONS.items():
        short = "cc " + elements.replace("-", " ")
        whole = rf"(?:{short}|creative commons {long})"
        keywords = (f" {short} ", " creative commons attribution ")
        ends = r"(?! (?:nc|nd|sa|non|no|share)\b)"
        found += [
            (f"cc-{elements}", whole + ends + LICENSE_WORD, keywords, NAMED),
            (f"cc-{elements}", GRANT + whole + ends + LICENSE_WORD, keywords, GRANTED),
        ]
        for version in COMMONS_VERSIONS:
            number = rf"{LICENSE_WORD} {_version(version)}{LICENSE_WORD}"
            found += [
                (f"cc-{elements}-{version}", whole + number, keywords, GRANTED),
                (f"cc-{elements}-{version}", GRANT + whole + number, keywords, TAGGED),
            ]
    found += STATEMENTS
    return [
        {"label": label, "pattern": f"(?<= ){pattern}(?= )", "keywords": list(keywords), "priority": priority}
        for label, pattern, keywords, priority in found
    ]


RULE_TYPE = "array<struct<label:string,pattern:string,keywords:array<string>,priority:int>>"


def _literal(table: list[dict]) -> Column:
    """The rules as one constant, parsed when the plan is made."""
    return F.from_json(F.lit(json.dumps(table)), RULE_TYPE)


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _matches(words: Column, rule: Column) -> Column:
    """Every match of a rule as an interval of words, from 0, the end not included.

    ``words`` stand between single spaces, with one at either end. What lies between two matches
    then has one space more than words, a match one less.
    """
    def intervals(found: Column) -> Column:
        between = F.split(words, rule["pattern"])

        def place(gaps: Column) -> Column:
            pairs = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("match"))
            start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("all"))

            def step(so_far: Column, pair: Column) -> Column:
                first = so_far["at"] + _spaces(pair["gap"]) - 1
                stop = first + _spaces(pair["match"]) + 1
                return F.struct(stop.alias("at"), F.concat(
                    so_far["all"], F.array(F.struct(first.alias("start"), stop.alias("stop")))).alias("all"))

            return F.aggregate(pairs, start, step, lambda so_far: so_far["all"])

        return let(between, place)

    found = F.regexp_extract_all(words, rule["pattern"], F.lit(0))
    return let(found, lambda own: F.when(F.size(own) > 0, intervals(own)).otherwise(
        F.array().cast("array<struct<start:int,stop:int>>")))


def _detections(words: Column, table: list[dict]) -> Column:
    """All matches of all rules of whose keywords the words contain one."""
    known = sorted({keyword for rule in table for keyword in rule["keywords"]})
    present = F.filter(F.lit(known), lambda keyword: F.contains(words, keyword))
    likely = let(present, lambda own: F.filter(_literal(table), lambda rule: F.arrays_overlap(rule["keywords"], own)))
    return F.flatten(F.transform(likely, lambda rule: F.transform(_matches(words, rule), lambda place: F.struct(
        place["start"].alias("start"), (-place["stop"]).alias("back"), (-rule["priority"]).alias("level"),
        rule["label"].alias("label")))))


def _unsuppressed(detections: Column) -> Column:
    """Detections that lie inside no other of the same or a higher priority.

    Sorted by start, the longer and then the more important first, whatever contains an interval
    comes before it. It is enough to remember, for every priority, how far detections of at least
    that priority have reached.
    """
    element = "array<struct<start:int,back:int,level:int,label:string>>"
    start = F.struct(
        F.array(*[F.lit(-1)] * LEVELS).alias("reach"), F.array().cast(element).alias("kept"))

    def step(so_far: Column, one: Column) -> Column:
        stop, priority = -one["back"], -one["level"]
        reach = F.transform(so_far["reach"], lambda far, level: F.when(
            level < priority, F.greatest(far, stop)).otherwise(far))
        inside = so_far["reach"][priority - 1] >= stop
        return F.when(inside, so_far).otherwise(F.struct(
            reach.alias("reach"), F.concat(so_far["kept"], F.array(one)).cast(element).alias("kept")))

    return F.aggregate(F.sort_array(detections), start, step, lambda so_far: so_far["kept"])


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections.

    ``n_base`` counts the places of the base phrases, ``first_word`` and ``last_word`` are the
    smallest and largest word they start at, NULL where there is none. ``labels`` holds the base
    labels and those of the detections that no other suppresses; ``detections`` lists these with
    start and stop in words. ``score`` is the confidence of the strongest one, 0 without any.

    A NULL text has no words. Rows are independent of each other, so repeated rows get equal answers
    and a frequent phrase makes no hot key. Columns other than doc_id and text are ignored.
    """
    table = rules()
    base = [
        {"label": label, "pattern": f"(?<= ){phrase}(?= )", "keywords": [f" {phrase} "], "priority": BARE}
        for phrase, label in BASE.items()
    ]
    rows = docs.select(docs["doc_id"], text_of(docs).alias("_text"))
    rows = rows.withColumn("_lower", F.lower("_text"))
    likely = None
    for stem in STEMS:
        found = F.contains(F.col("_lower"), F.lit(stem))
        likely = found if likely is None else likely | found
    plain = F.regexp_replace(F.translate("_text", UPPER, LOWER), BETWEEN, " ")
    words = F.when(likely, F.concat(F.lit(" "), F.trim(plain), F.lit(" "))).otherwise(F.lit(""))
    rows = rows.select(
        "doc_id", F.regexp_count("_text", F.lit(ANY_CASE_WORD)).cast("bigint").alias("n_words"), words.alias("_words"))
    none = F.array().cast("array<struct<start:int,back:int,level:int,label:string>>")

    def found(known: list[dict]) -> Column:
        return F.when(F.col("_words") != "", _detections(F.col("_words"), known)).otherwise(none)

    rows = rows.select("doc_id", "n_words", found(base).alias("_base"), found(table).alias("_all"))
    rows = rows.select("doc_id", "n_words", "_base", F.when(
        F.size("_all") > 0, _unsuppressed(F.col("_all"))).otherwise(none).alias("_kept"))
    starts = F.transform("_base", lambda one: one["start"].cast("bigint"))
    own = F.transform("_base", lambda one: one["label"])
    every = F.concat(own, F.transform("_kept", lambda one: one["label"]))
    strength = F.create_map(*[F.lit(x) for level, share in CONFIDENCE.items() for x in (level, share)])
    levels = F.concat(F.transform("_base", lambda one: -one["level"]), F.transform("_kept", lambda one: -one["level"]))

    def joined(labels: Column) -> Column:
        return F.array_join(F.sort_array(F.array_distinct(labels)), ",")

    return rows.select(
        "doc_id", "n_words", F.size("_base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(own).alias("base_labels"), joined(every).alias("labels"),
        F.coalesce(strength[F.array_max(levels)], F.lit(0.0)).alias("score"),
        F.transform("_kept", lambda one: F.struct(
            one["start"].alias("start"), (-one["back"]).alias("stop"), one["label"].alias("label"))).alias("detections"))
