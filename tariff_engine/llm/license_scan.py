"""License scan by ordered signature rules, with DataFrame functions only and no shuffle.

A text becomes its lower-cased words, each between its own two blanks, so that rules are regexes over words and
a span's word positions are half its blanks. A rule runs only on texts that contain its keyword; texts with no
keyword at all stop after the word count. Overlaps resolve by priority and containment: a detection inside
another one of higher priority (or of equal priority and longer, or equal in both and earlier in rule order)
is suppressed. The three fixed phrases have the highest priority and are never suppressed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariff_engine.llm.columns import ascii_lower

#: Phrase and label of the base detections.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: (label, keyword, name as a regex over words). The keyword is in every text that the name can match. A label can have
#: several names. A name with "licen" in it is whole: no form asks for a further "license" after it.
FAMILIES = [
    ("mit", "mit", r"mit"),
    ("mit", "expat", r"expat"),
    ("apache-1", "apache", r"apache (?:software )?licen[cs]e (?:version |v ?)?1(?: [01])?"),
    ("apache-1", "apache", r"apache (?:software )?(?:version |v ?)?1(?: [01])?"),
    ("apache-2", "apache", r"apache (?:software )?licen[cs]e (?:version |v ?)?2(?: 0)?"),
    ("apache-2", "apache", r"apache (?:software )?(?:version |v ?)?2(?: 0)?"),
    ("apache", "apache", r"apache(?: software)?"),
    ("gpl-2", "general public", r"gnu general public licen[cs]e (?:version |v ?)?2(?: 0)?"),
    ("gpl-3", "general public", r"gnu general public licen[cs]e (?:version |v ?)?3(?: 0)?"),
    ("gpl", "general public", r"gnu general public licen[cs]e"),
    ("gpl", "gpl", r"(?:gnu )?gpl(?: ?v?[123](?: 0)?)?"),
    ("lgpl", "general public", r"gnu (?:lesser|library) general public licen[cs]e"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl(?: ?v?[23](?: [01])?)?"),
    ("lgpl-2.1", "lesser general", r"gnu lesser general public licen[cs]e (?:version |v ?)?2 1"),
    ("lgpl-3", "lesser general", r"gnu lesser general public licen[cs]e (?:version |v ?)?3(?: 0)?"),
    ("agpl-3", "affero", r"(?:gnu )?affero general public licen[cs]e(?: (?:version |v ?)?3(?: 0)?)?"),
    ("agpl", "agpl", r"(?:gnu )?agpl(?: ?v?3(?: 0)?)?"),
    ("fdl", "free documentation", r"gnu free documentation licen[cs]e(?: version 1 [123])?"),
    ("bsd-2", "bsd", r"(?:bsd 2 clause|simplified bsd|freebsd)"),
    ("bsd-3", "bsd", r"(?:bsd 3 clause|modified bsd|new bsd|revised bsd)"),
    ("bsd-4", "bsd", r"(?:bsd 4 clause|original bsd)"),
    ("bsd", "bsd", r"bsd"),
    ("0bsd", "0bsd", r"0bsd"),
    ("isc", "isc", r"isc"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[cs]e (?:version |v ?)?1 1"),
    ("mpl-2", "mozilla", r"mozilla public licen[cs]e (?:version |v ?)?2(?: 0)?"),
    ("mpl", "mozilla", r"mozilla public licen[cs]e"),
    ("mpl", "mpl", r"mpl(?: [12](?: [01])?)?"),
    ("epl-1", "eclipse", r"eclipse public licen[cs]e (?:version |v ?)?1(?: 0)?"),
    ("epl-2", "eclipse", r"eclipse public licen[cs]e (?:version |v ?)?2(?: 0)?"),
    ("epl", "eclipse", r"eclipse public licen[cs]e"),
    ("edl", "eclipse", r"eclipse distribution"),
    ("cddl", "common development", r"common development and distribution"),
    ("cpl", "common public", r"common public"),
    ("eupl", "european union", r"european union public"),
    ("artistic", "artistic", r"artistic(?: [12](?: 0)?)?"),
    ("boost", "boost", r"boost software"),
    ("zlib", "zlib", r"zlib(?: libpng)?"),
    ("unlicense", "unlicense", r"unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("cc0", "cc0", r"cc0(?: 1 0)?"),
    ("cc-by", "cc by", r"cc by(?! (?:nc|nd|sa))(?: [1234] 0)?"),
    ("cc-by-sa", "cc by sa", r"cc by sa(?: [1234] 0)?"),
    ("cc-by-nd", "cc by nd", r"cc by nd(?: [1234] 0)?"),
    ("cc-by-nc", "cc by nc", r"cc by nc(?! (?:nd|sa))(?: [1234] 0)?"),
    ("cc-by-nc-sa", "cc by nc sa", r"cc by nc sa(?: [1234] 0)?"),
    ("cc-by-nc-nd", "cc by nc nd", r"cc by nc nd(?: [1234] 0)?"),
    ("creative-commons", "creative commons", r"creative commons(?: attribution)?(?: (?:share ?alike|non ?commercial|no ?deriv\w*))*"),
    ("ofl", "open font", r"(?:sil )?open font"),
    ("python", "python software", r"python software foundation"),
    ("postgresql", "postgresql", r"postgresql"),
    ("openssl", "openssl", r"openssl"),
    ("ms-pl", "microsoft", r"microsoft public"),
    ("ms-rl", "microsoft", r"microsoft reciprocal"),
    ("odbl", "open database", r"open database"),
]

#: How a licence is named: (priority, confidence, words before, words after, a second keyword beside the name's).
FORMS = (
    (60, 1.0, r"spdx license identifier ", r"(?: only| or later)?", "spdx"),
    (50, 0.95, r"licen[cs]ed under (?:the )?(?:terms of )?(?:the )?", r"(?: licen[cs]e)?", "licen"),
    (50, 0.95, r"(?:released|distributed|published|available) under (?:the )?(?:terms of )?(?:the )?", r" licen[cs]e", "licen"),
    (30, 0.85, r"(?:subject to|covered by|governed by) (?:the )?", r" licen[cs]e", "licen"),
    (20, 0.75, r"", r" (?:software )?licen[cs]e(?: version [0-9](?: [0-9])?| v[0-9])?", "licen"),
)

#: Rules that name no family: label -> (keyword, regex over words, priority, confidence).
NOTICES = {
    "proprietary": ("rights reserved", r"all rights reserved", 10, 0.5),
    "copyright": ("copyright", r"copyright (?:c )?(?:19|20)[0-9][0-9]", 10, 0.4),
    "public-domain": ("public domain", r"(?:in|into|to) the public domain", 10, 0.6),
    "no-warranty": ("warranty", r"without warranty of any kind", 5, 0.3),
    "as-is": ("provided as is", r"provided as is", 5, 0.3),
    "permission": ("permission is", r"permission is hereby granted free of charge", 15, 0.7),
    "redistribution": ("redistribution", r"redistribution and use in source and binary forms", 15, 0.7),
    "noncommercial": ("commercial", r"(?:for )?non ?commercial (?:use|purposes)(?: only)?", 8, 0.4),
}

#: Detections of the fixed phrases stand above every rule.
BASE_PRIORITY = 100

_DETECTIONS = (
    "array<struct<first:bigint,last:bigint,label:string,rule:int,priority:int,confidence:double>>"
)

_BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    also: str
    regex: str
    priority: int
    confidence: float


def _over_words(pattern: str) -> str:
    """The pattern over single-spaced words, as one over words that stand between two blanks each."""
    return " " + pattern.replace(" ?", "(?: )?").replace(" ", "  ") + " "


def rules() -> list[Rule]:
    """All rules in order: the fixed phrases, every family in every form, then the notices."""
    out = [Rule(label, phrase, phrase, _over_words(phrase), BASE_PRIORITY, 1.0) for phrase, label in PHRASES.items()]
    for priority, confidence, before, after, also in FORMS:
        for label, keyword, name in FAMILIES:
            rest = f"(?:{after})?" if "licen" in name else after
            out.append(Rule(label, keyword, also.strip(), _over_words(before + name + rest), priority, confidence))
    for label, (keyword, pattern, priority, confidence) in NOTICES.items():
        out.append(Rule(label, keyword, keyword, _over_words(pattern), priority, confidence))
    return out


def _words_in(spaced: Column) -> Column:
    """Words of a string in which every word has its own two blanks."""
    return ((F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit("")))) / 2).cast("long")


def _rule_table(listed: list[Rule]) -> Column:
    """The rules as one literal array; keywords and regexes are in the doubly spaced form."""
    return F.array(*[
        F.struct(
            F.lit(r.keyword.replace(" ", "  ")).alias("keyword"), F.lit(r.also.replace(" ", "  ")).alias("also"),
            F.lit(r.regex).alias("regex"), F.lit(r.label).alias("label"), F.lit(number).alias("rule"),
            F.lit(r.priority).alias("priority"), F.lit(r.confidence).alias("confidence"),
        )
        for number, r in enumerate(listed)
    ])


def _spans(spaced: Column, rule: Column) -> Column:
    """Every place of a rule, left to right, as detections."""
    between = F.split(spaced, rule["regex"], -1)
    hits = F.regexp_extract_all(spaced, rule["regex"], F.lit(0))

    def step(acc: Column, x: Column) -> Column:
        first = acc["at"] + _words_in(x["gap"])
        after = first + _words_in(x["hit"])
        detection = F.struct(
            first.alias("first"), (after - 1).alias("last"), rule["label"].alias("label"), rule["rule"].alias("rule"),
            rule["priority"].alias("priority"), rule["confidence"].alias("confidence"),
        )
        return F.struct(after.alias("at"), F.concat(acc["out"], F.array(detection)).alias("out"))

    return F.aggregate(
        F.arrays_zip(F.slice(between, F.lit(1), F.size(hits)).alias("gap"), hits.alias("hit")),
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_DETECTIONS).alias("out")),
        step,
        lambda acc: acc["out"],
    )


def license_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections.

    ``detections`` holds what survives suppression, ordered by place: label, rule number, priority, confidence,
    first and last word (counted from 0). ``base_labels`` and ``labels`` are distinct, sorted and comma-joined;
    ``score`` is the highest confidence of a surviving detection, 0 without any. With ``carry``, the struct
    ``row`` holds every input column.

    Null and empty texts have no words and no labels; first and last word are null where no phrase stands.
    Null ids, repeated rows and extra columns pass through; an empty table gives none. Texts of any length are scanned
    whole; the detections of one text are compared with each other, so the time of a text grows with the square of
    their number (some seconds for a thousand notices in one text).
    """
    listed = rules()
    row = [F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")] if carry else []
    words = df.select(
        F.col(f"`{id_col}`").alias("doc_id"), *row,
        F.trim(F.regexp_replace(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), _BREAKS, " ")).alias("words"),
    ).withColumn(
        "n_words",
        F.when(F.col("words") == "", F.lit(0).cast("long")).otherwise(
            (F.length("words") - F.length(F.replace(F.col("words"), F.lit(" "), F.lit(""))) + 1).cast("long")
        ),
    )
    lowered = F.lower("words")
    also = {r.also for r in listed}
    gates = sorted(k for k in also if not any(o != k and o in k for o in also))
    gate = F.lit(False)
    for keyword in gates:
        gate = gate | F.contains(F.col("any_case"), F.lit(keyword))
    words = words.withColumn("any_case", lowered).withColumn(
        # null, and with it everything below, for texts without any keyword
        "spaced", F.when(gate, F.concat(F.lit(" "), F.replace(ascii_lower(F.col("words")), F.lit(" "), F.lit("  ")), F.lit(" ")))
    ).drop("any_case", "words")

    spaced = F.col("spaced")
    pieces = {p: F.split(spaced, _over_words(p), -1) for p in PHRASES}
    base = words.withColumn(
        "base",
        F.when(
            spaced.isNotNull(),
            F.array(*[
                F.struct(
                    F.lit(label).alias("label"),
                    (F.size(pieces[p]) - 1).cast("long").alias("n"),
                    _words_in(F.element_at(pieces[p], 1)).alias("first"),
                    (F.col("n_words") - _words_in(F.element_at(pieces[p], -1)) - len(p.split())).alias("last"),
                )
                for p, label in PHRASES.items()
            ]),
        ),
    ).withColumn("base", F.filter("base", lambda b: b["n"] > 0))

    candidates = F.filter(_rule_table(listed), lambda r: F.contains(spaced, r["keyword"]) & F.contains(spaced, r["also"]))
    found = base.withColumn(
        "found", F.when(spaced.isNotNull(), F.flatten(F.transform(candidates, lambda r: _spans(spaced, r))))
    )

    def hides(o: Column, d: Column) -> Column:
        inside = (o["first"] <= d["first"]) & (o["last"] >= d["last"])
        longer, span = o["last"] - o["first"], d["last"] - d["first"]
        above = (o["priority"] > d["priority"]) | (
            (o["priority"] == d["priority"]) & ((longer > span) | ((longer == span) & (o["rule"] < d["rule"])))
        )
        return inside & above

    kept = found.withColumn(
        "detections",
        F.array_sort(
            F.filter(
                F.coalesce("found", F.array().cast(_DETECTIONS)),
                lambda d: (d["priority"] == BASE_PRIORITY) | ~F.exists("found", lambda o: hides(o, d)),
            )
        ),
    )
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    none = F.array().cast("array<string>")
    return kept.select(
        "doc_id",
        "n_words",
        F.coalesce(F.aggregate("base", F.lit(0).cast("long"), lambda a, b: a + b["n"]), F.lit(0).cast("long")).alias("n_base"),
        F.array_min(F.transform("base", lambda b: b["first"])).alias("first_word"),
        F.array_max(F.transform("base", lambda b: b["last"])).alias("last_word"),
        joined(F.coalesce(F.transform("base", lambda b: b["label"]), none)).alias("base_labels"),
        joined(F.transform("detections", lambda d: d["label"])).alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0)).alias("score"),
        "detections",
        *(["row"] if carry else []),
    )
