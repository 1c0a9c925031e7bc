"""License scans: ordered signature rules with keyword prefilter and suppression of overlaps.

A rule is a regular expression with a label, a keyword and a priority. A text is searched by a rule only
if it holds all words of the rule's keyword, and by any rule only if it holds one of a few common stems. Detections that
lie inside another detection of the same or higher priority are dropped.

Rules per license: its name (written by hand below), its machine-readable tag, and its address; the last
two are built from the table. Phrase rules of the base match whole words whatever stands between them; names and stems
too take any run of non-word characters where a blank is written, so line ends and comment marks within a notice do not matter.

Everything is built-in functions on one row at a time: the rules are a constant array of structs that a
filter and a transform walk over, so the plan does not grow with their number.

Defined cases: a null text is scanned as empty; repeated rows are scanned alike; an empty table gives an empty result; among
equal intervals the first rule in order stays; other columns of the input pass through.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import furthest, let, matches, unused

# ---------------------------------------------------------------- fixed values
# Characters of a word after A-Z are lower-cased, and phrases of the base with their labels.
LOWER_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE_PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
# ---------------------------------------------------------------- end of fixed values
# The same words in a text that is not lower-cased: A-Z are word characters too.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def phrase_pattern(phrases) -> str:
    """One pattern for whole-word phrases in any ASCII case, with any run of non-word characters between words."""
    inner = "|".join(_NOT_WORD.join(p.split()) for p in phrases)
    word = WORD[:-1]
    return f"(?i)(?<!{word})(?:{inner})(?!{word})"


def gapped(name: str) -> str:
    """The pattern with any run of non-word characters for a blank, a blank or hyphen, and a comma and a blank.

    The runs are possessive: nothing that may follow one begins inside it.
    """
    out = name.replace(",? ", " ").replace(", ", " ").replace(".{0,3}", f"(?:.{{0,3}}|{_NOT_WORD}+)")
    out = out.replace("[ -]?", f"{_NOT_WORD[:-1]}*+").replace(" ?", f"{_NOT_WORD[:-1]}*+")
    return out.replace("[ -]", " ").replace(" ", f"{_NOT_WORD}+")


# (label, keyword of the name, name pattern, SPDX id or None, part of its address or None)
LICENSES = (
    ("agpl-3", "affero", r"affero general public licen[cs]e(?:,? version 3| v?3)?", "AGPL-3.0", "gnu.org/licenses/agpl"),
    ("lgpl-2", "lesser", r"lesser general public licen[cs]e,? (?:version|v\.?) ?2", "LGPL-2.1", "gnu.org/licenses/lgpl-2"),
    ("lgpl-3", "lesser", r"lesser general public licen[cs]e,? (?:version|v\.?) ?3", "LGPL-3.0", "gnu.org/licenses/lgpl-3"),
    ("lgpl", "general public", r"(?:lesser|library) general public licen[cs]e", None, "gnu.org/licenses/lgpl"),
    ("gpl-3", "general public", r"(?:gnu )?general public licen[cs]e,? (?:version|v\.?) ?3", "GPL-3.0", "gnu.org/licenses/gpl-3"),
    ("gpl-2", "general public", r"(?:gnu )?general public licen[cs]e,? (?:version|v\.?) ?2", "GPL-2.0", "gnu.org/licenses/gpl-2"),
    ("gpl", "general public", r"(?:gnu )?general public licen[cs]e", None, "gnu.org/licenses/gpl"),
    ("gfdl", "free documentation", r"gnu free documentation licen[cs]e", "GFDL-1.3", "gnu.org/licenses/fdl"),
    ("apache-2", "apache", r"apache (?:software )?licen[cs]e,? (?:version|v\.?) ?2(?:\.0)?", "Apache-2.0", "apache.org/licenses/license-2"),
    ("apache-1", "apache", r"apache (?:software )?licen[cs]e,? (?:version|v\.?) ?1(?:\.[01])?", "Apache-1.1", "apache.org/licenses/license-1"),
    ("apache", "apache", r"apache (?:software )?licen[cs]e", None, "apache.org/licenses"),
    ("mit", "mit", r"(?:the )?\bmit licen[cs]e|licensed under mit\b", "MIT", "opensource.org/licenses/mit"),
    ("mit", "free of charge", r"permission is hereby granted, free of charge, to any person obtaining a copy", None, None),
    ("mit-0", "mit no attribution", r"mit no attribution", "MIT-0", None),
    ("bsd-2", "bsd", r"(?:bsd[ -]2[ -]clause|simplified bsd|freebsd) licen[cs]e", "BSD-2-Clause", "opensource.org/licenses/bsd-2"),
    ("bsd-3", "bsd", r"(?:bsd[ -]3[ -]clause|new bsd|modified bsd|revised bsd) licen[cs]e", "BSD-3-Clause", "opensource.org/licenses/bsd-3"),
    ("bsd-4", "bsd", r"(?:bsd[ -]4[ -]clause|original bsd) licen[cs]e", "BSD-4-Clause", None),
    ("0bsd", "bsd", r"(?:bsd[ -]?zero clause|zero[ -]clause bsd)", "0BSD", "opensource.org/licenses/0bsd"),
    ("bsd", "bsd", r"\bbsd licen[cs]e", None, "opensource.org/licenses/bsd-license"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms", None, None),
    ("mpl-2", "mozilla", r"mozilla public licen[cs]e,? (?:version|v\.?) ?2(?:\.0)?", "MPL-2.0", "mozilla.org/mpl/2"),
    ("mpl-1", "mozilla", r"mozilla public licen[cs]e,? (?:version|v\.?) ?1(?:\.[01])?", "MPL-1.1", "mozilla.org/mpl/1"),
    ("mpl", "mozilla", r"mozilla public licen[cs]e", None, "mozilla.org/mpl"),
    ("epl-2", "eclipse", r"eclipse public licen[cs]e,? (?:-|version|v\.?)? ?2(?:\.0)?", "EPL-2.0", "eclipse.org/legal/epl-2"),
    ("epl-1", "eclipse", r"eclipse public licen[cs]e,? (?:-|version|v\.?)? ?1(?:\.0)?", "EPL-1.0", "eclipse.org/legal/epl-v10"),
    ("cddl", "common development", r"common development and distribution licen[cs]e", "CDDL-1.0", "opensource.org/licenses/cddl"),
    ("cpl", "common public", r"common public licen[cs]e", "CPL-1.0", "opensource.org/licenses/cpl"),
    ("eupl", "european union", r"european union public licen[cs]e", "EUPL-1.2", "eupl.eu"),
    ("osl-3", "open software", r"open software licen[cs]e", "OSL-3.0", "opensource.org/licenses/osl"),
    ("afl-3", "academic free", r"academic free licen[cs]e", "AFL-3.0", "opensource.org/licenses/afl"),
    ("artistic-2", "artistic", r"artistic licen[cs]e,? (?:version|v\.?)? ?2", "Artistic-2.0", "opensource.org/licenses/artistic-license-2"),
    ("artistic", "artistic", r"artistic licen[cs]e", "Artistic-1.0", "opensource.org/licenses/artistic"),
    ("isc", "isc", r"\bisc licen[cs]e", "ISC", "opensource.org/licenses/isc"),
    ("isc", "with or without fee", r"permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose with or without fee", None, None),
    ("zlib", "zlib", r"zlib(?:/libpng)? licen[cs]e", "Zlib", "opensource.org/licenses/zlib"),
    ("bsl-1", "boost", r"boost software licen[cs]e", "BSL-1.0", "boost.org/license_1_0"),
    ("busl", "business source", r"business source licen[cs]e", "BUSL-1.1", "mariadb.com/bsl"),
    ("elastic-2", "elastic", r"elastic licen[cs]e(?: 2\.0)?", "Elastic-2.0", "elastic.co/licensing"),
    ("sspl-1", "server side", r"server side public licen[cs]e", "SSPL-1.0", "mongodb.com/licensing/server-side"),
    ("unlicense", "unlicense", r"\bthe unlicense\b", "Unlicense", "unlicense.org"),
    ("unlicense", "public domain", r"free and unencumbered software released into the public domain", None, None),
    ("wtfpl", "wtfpl", r"\bwtfpl\b", "WTFPL", "wtfpl.net"),
    ("cc0", "cc0", r"\bcc0\b(?: 1\.0)?", "CC0-1.0", "creativecommons.org/publicdomain/zero"),
    ("public-domain", "public domain", r"(?:released|dedicated|placed) (?:in)?to the public domain", None, "creativecommons.org/publicdomain/mark"),
    ("cc-by-nc-nd", "nc", r"\bcc[ -]by[ -]nc[ -]nd\b(?: \d\.\d)?", "CC-BY-NC-ND-4.0", "creativecommons.org/licenses/by-nc-nd"),
    ("cc-by-nc-sa", "nc", r"\bcc[ -]by[ -]nc[ -]sa\b(?: \d\.\d)?", "CC-BY-NC-SA-4.0", "creativecommons.org/licenses/by-nc-sa"),
    ("cc-by-nc", "nc", r"\bcc[ -]by[ -]nc\b(?: \d\.\d)?", "CC-BY-NC-4.0", "creativecommons.org/licenses/by-nc"),
    ("cc-by-nd", "nd", r"\bcc[ -]by[ -]nd\b(?: \d\.\d)?", "CC-BY-ND-4.0", "creativecommons.org/licenses/by-nd"),
    ("cc-by-sa", "sa", r"\bcc[ -]by[ -]sa\b(?: \d\.\d)?", "CC-BY-SA-4.0", "creativecommons.org/licenses/by-sa"),
    ("cc-by", "cc", r"\bcc[ -]by\b(?: \d\.\d)?", "CC-BY-4.0", "creativecommons.org/licenses/by"),
    ("cc-by-nc", "commercial", r"creative commons attribution[ -]non[ -]?commercial", None, None),
    ("cc-by-sa", "alike", r"creative commons attribution[ -]share[ -]?alike", None, None),
    ("cc-by-nd", "deriv", r"creative commons attribution[ -]no[ -]?deriv(?:ative)?s?", None, None),
    ("cc-by", "creative commons", r"creative commons attribution(?: \d\.\d)?", None, None),
    ("odbl", "open database", r"open (?:data commons )?(?:open )?database licen[cs]e", "ODbL-1.0", "opendatacommons.org/licenses/odbl"),
    ("odc-by", "open data commons", r"open data commons attribution", "ODC-By-1.0", "opendatacommons.org/licenses/by"),
    ("pddl", "public domain dedication", r"public domain dedication and licen[cs]e", "PDDL-1.0", "opendatacommons.org/licenses/pddl"),
    ("cdla-permissive", "community data", r"community data licen[cs]e agreement.{0,3}permissive", "CDLA-Permissive-2.0", "cdla.dev/permissive"),
    ("cdla-sharing", "community data", r"community data licen[cs]e agreement.{0,3}sharing", "CDLA-Sharing-1.0", "cdla.dev/sharing"),
    ("ofl", "open font", r"sil open font licen[cs]e", "OFL-1.1", "scripts.sil.org/ofl"),
    ("psf", "python", r"python software foundation licen[cs]e", "PSF-2.0", "docs.python.org/license"),
    ("php", "php", r"\bphp licen[cs]e", "PHP-3.01", "php.net/license"),
    ("ruby", "ruby", r"\bruby licen[cs]e", "Ruby", "ruby-lang.org/en/about/license"),
    ("openssl", "openssl", r"openssl licen[cs]e", "OpenSSL", "openssl.org/source/license"),
    ("postgresql", "postgresql", r"postgresql licen[cs]e", "PostgreSQL", "opensource.org/licenses/postgresql"),
    ("ms-pl", "microsoft public", r"microsoft public licen[cs]e", "MS-PL", "opensource.org/licenses/ms-pl"),
    ("ms-rl", "microsoft reciprocal", r"microsoft reciprocal licen[cs]e", "MS-RL", "opensource.org/licenses/ms-rl"),
    ("upl", "universal permissive", r"universal permissive licen[cs]e", "UPL-1.0", "opensource.org/licenses/upl"),
    ("ncsa", "ncsa", r"(?:university of illinois/)?ncsa open source licen[cs]e", "NCSA", "opensource.org/licenses/ncsa"),
    ("ecl-2", "educational community", r"educational community licen[cs]e", "ECL-2.0", "opensource.org/licenses/ecl"),
    ("mulan-2", "mulan", r"mulan p(?:ermissive )?s(?:oftware )?l(?:icense)?(?:,? version 2| v2)?", "MulanPSL-2.0", "license.coscl.org.cn/mulanpsl"),
    ("vim", "vim", r"\bvim licen[cs]e", "Vim", None),
    ("x11", "x11", r"\bx11 licen[cs]e", "X11", None),
    ("blueoak", "blue oak", r"blue oak model licen[cs]e", "BlueOak-1.0.0", "blueoakcouncil.org/license"),
    ("bloom-rail", "rail", r"\b(?:open ?)?rail(?:-m)? licen[cs]e", "BigScience-OpenRAIL-M", "bigscience.huggingface.co/blog/bloom-rail"),
    ("llama", "llama", r"llama (?:\d(?:\.\d)? )?community licen[cs]e", None, "ai.meta.com/llama/license"),
    ("proprietary", "all rights reserved", r"all rights reserved", None, None),
    ("confidential", "confidential", r"proprietary and confidential|confidential and proprietary", None, None),
    ("licensed", "under the terms", r"licen[cs]ed under the terms of", None, None),
)
NAME, ADDRESS, TAG, BASE = 1, 2, 3, 4  # priorities
CONFIDENCE = {0: 0.0, NAME: 0.7, ADDRESS: 0.85, TAG: 0.95, BASE: 1.0}


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: str
    priority: int


def license_rules() -> tuple[Rule, ...]:
    """The signature rules in order: base phrases, tags, addresses, names."""
    base = [Rule(label, p.split()[-1] if "mit" not in p else "mit", phrase_pattern([p]), BASE) for p, label in BASE_PHRASES]
    tags = [
        Rule(label, "spdx", rf"(?i)spdx-license-identifier:\s*{re.escape(spdx)}(?:-only|-or-later|\+)?(?![\w.-])", TAG)
        for label, _, _, spdx, _ in LICENSES
        if spdx
    ]
    addresses = [Rule(label, at, rf"(?i)(?:https?://)?(?:www\.)?{re.escape(at)}[\w./-]*", ADDRESS) for label, _, _, _, at in LICENSES if at]
    names = [Rule(label, keyword, f"(?i){gapped(name)}", NAME) for label, keyword, name, _, _ in LICENSES]
    return tuple(base + tags + addresses + names)


RULES = license_rules()
# A lower-cased text that holds none of these, with any gap for a blank, holds no match of a rule above.
STEMS = (
    "licen", "spdx", "commons", "cc by", "cc0", "permission is hereby", "permission to use", "redistribution and use",
    "public domain", "all rights reserved", "confidential", "mozilla.org/mpl", "eclipse.org/legal", "eupl.eu", "mariadb.com/bsl",
    "wtfpl", "cdla.dev", "sil.org/ofl", "bloom-rail", "mit no attribution", "bsd", "mulan p",
)
# The same for the phrases of the base.
BASE_STEM = r"(?i)license|by[^a-z0-9]+nc"

DETECTION = "array<struct<start:int,end:int,priority:int,ord:int,label:string>>"


def detections(text: Column, lowered: Column, rules: tuple[Rule, ...] = RULES, stems: tuple[str, ...] = STEMS) -> Column:
    """All detections of a text (``lowered``: the same in lower case) by start, longest first, none inside another of the same or higher priority."""
    table = F.array(
        *[
            F.struct(
                F.lit(i).alias("ord"), F.lit(r.label).alias("label"), F.array(*map(F.lit, r.keyword.split())).alias("keyword"),
                F.lit(r.pattern).alias("pattern"), F.lit(r.priority).alias("priority"),
            )
            for i, r in enumerate(rules)
        ]
    )
    usable = F.filter(table, lambda r: F.forall(r["keyword"], lambda k: F.contains(lowered, k)))

    def search(r: Column) -> Column:
        return F.transform(
            matches(text, r["pattern"]),
            lambda m: F.struct(
                m["start"].alias("start"), (-m["end"]).alias("minus_end"), (-r["priority"]).alias("minus_priority"),
                r["ord"].alias("ord"), r["label"].alias("label"),
            ),
        )

    found = F.sort_array(F.flatten(F.transform(usable, search)))
    levels = sorted({r.priority for r in rules})

    def ends(f: Column, level: int) -> Column:
        return F.transform(f, lambda d: F.when(-d["minus_priority"] >= level, -d["minus_end"]).otherwise(-1))

    def uncontained(f: Column, reach: Column) -> Column:
        # In this order whatever contains d has come before it: it is inside one of them if the furthest
        # end so far, among those of its priority or higher, reaches its end.
        def free(d: Column, i: Column) -> Column:
            before = F.coalesce(*[F.when(-d["minus_priority"] == level, F.get(reach[f"end{level}"], i)) for level in levels])
            return before < -d["minus_end"]

        return F.filter(f, free)

    kind = "array<struct<start:int,minus_end:int,minus_priority:int,ord:int,label:string>>"
    kept = let(
        found.cast(kind),
        lambda f: let(F.struct(*[furthest(ends(f, level)).alias(f"end{level}") for level in levels]), lambda reach: uncontained(f, reach)),
    )
    shaped = F.transform(
        kept,
        lambda d: F.struct(
            d["start"].alias("start"), (-d["minus_end"]).alias("end"), (-d["minus_priority"]).alias("priority"),
            d["ord"].alias("ord"), d["label"].alias("label"),
        ),
    )
    held = [holds(lowered, s) for s in stems]
    return F.when(reduce(lambda a, b: a | b, held) | base_gate(text), shaped).otherwise(F.array()).cast(DETECTION)


def holds(lowered: Column, stem: str) -> Column:
    """Whether the text holds the stem; the words of one come first, as they are cheaper to look for than the gaps."""
    parts = stem.split()
    every = reduce(lambda a, b: a & b, [F.contains(lowered, F.lit(p)) for p in parts])
    return every & F.regexp_like(lowered, F.lit(_NOT_WORD.join(parts))) if len(parts) > 1 else every


def base_gate(text: Column) -> Column:
    return F.regexp_like(text, F.lit(BASE_STEM))


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD))


def base_places(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with n_words, n_base, first_word, last_word, base_labels_array of the fixed phrases."""
    pattern = F.lit(phrase_pattern([p for p, _ in BASE_PHRASES]))
    found = base_gate(text) & F.regexp_like(text, pattern)
    hits = F.when(found, F.regexp_extract_all(text, pattern, F.lit(0))).otherwise(F.array().cast("array<string>"))
    gaps = F.when(found, F.split(text, pattern, -1))
    some = docs.withColumns({"n_words": n_words(text).cast("long"), "base_hits": hits, "base_gaps": gaps})
    last = F.col("n_words") - n_words(F.element_at("base_gaps", -1)) - n_words(F.element_at("base_hits", -1))


    def label_of(phrase: str, label: str) -> Column:
        return F.when(F.exists("base_hits", lambda h: F.regexp_like(h, F.lit(phrase_pattern([phrase])))), F.lit(label))

    labels = [label_of(p, label) for p, label in BASE_PHRASES]
    return some.withColumns(
        {
            "n_base": F.size("base_hits").cast("long"),
            "first_word": F.when(found, n_words(F.get("base_gaps", F.lit(0)))).cast("long"),
            "last_word": F.when(found, last).cast("long"),
            "base_labels_array": F.array_sort(F.array_compact(F.array(*labels))),
        }
    ).drop("base_hits", "base_gaps")


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_base, first_word, last_word, base_labels_array, detections, labels_array, score.

    ``score`` is the confidence of the strongest detection (0 for none).
    """
    t = F.coalesce(F.col(text), F.lit(""))
    low = unused(docs, "lowered")
    seen = base_places(docs.withColumn(low, F.lower(t)), t).withColumn("detections", detections(t, F.col(low))).drop(low)
    labels = F.array_sort(F.array_distinct(F.concat("base_labels_array", F.transform("detections", lambda d: d["label"]))))
    best = F.greatest(
        F.coalesce(F.array_max(F.transform("detections", lambda d: d["priority"])), F.lit(0)), F.when(F.col("n_base") > 0, BASE).otherwise(0)
    )
    score = F.element_at(F.array(*[F.lit(CONFIDENCE[i]) for i in range(BASE + 1)]), (best + 1).cast("int"))
    return seen.withColumns({"labels_array": labels, "score": score})
