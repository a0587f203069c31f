"""License scans by ordered signature rules.

A text is reduced to its words (ASCII letters, digits and everything beyond
ASCII; A-Z lower-cased) joined by single blanks.  Rules are regexes over that
string, each gated by a literal keyword; a detection is an interval of words.
Of overlapping detections, one that lies inside another is suppressed (equal
intervals: the higher priority, then the earlier rule, stays).

All of it is one projection: texts without any keyword only have their words
counted; for the others the rule table, a literal, is filtered by keyword and
applied with regex functions inside the row.  No shuffle, no user function, no
row identity needed; the cost follows the bytes of text.

Defined results: a null text counts as empty; equal rows are scanned alike;
columns of the input pass through, except that one named like ``out`` is
replaced; an empty table gives an empty one; very long texts are scanned whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import let

#: Phrases whose every place is counted, and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Licenses by label: a regex of the names that a notice uses, a regex of the
#: version after the name ('' if there is none), words of the identifier tag,
#: words of the address.
LICENSES = (
    ("gpl-2.0", "gnu general public licen[sc]e|gnu gpl|gpl", "2(?: 0)?", "gpl 2 0", "gnu org licenses (?:old licenses )?gpl 2 0"),
    ("gpl-3.0", "gnu general public licen[sc]e|gnu gpl|gpl", "3(?: 0)?", "gpl 3 0", "gnu org licenses gpl(?: 3 0)?"),
    ("lgpl-2.1", "gnu (?:lesser|library) general public licen[sc]e|gnu lgpl|lgpl", "2(?: [01])?", "lgpl 2 1", "gnu org licenses (?:old licenses )?lgpl 2 1"),
    ("lgpl-3.0", "gnu lesser general public licen[sc]e|gnu lgpl|lgpl", "3(?: 0)?", "lgpl 3 0", "gnu org licenses lgpl(?: 3 0)?"),
    ("agpl-3.0", "gnu affero general public licen[sc]e|gnu agpl|agpl", "3(?: 0)?", "agpl 3 0", "gnu org licenses agpl(?: 3 0)?"),
    ("gfdl-1.3", "gnu free documentation licen[sc]e|gfdl", "1 [123]", "gfdl 1 3", "gnu org licenses fdl(?: 1 3)?"),
    ("apache-1.1", "apache (?:software )?licen[sc]e", "1 [01]", "apache 1 1", "apache org licenses license 1 1"),
    ("apache-2.0", "apache (?:software )?licen[sc]e", "2(?: 0)?", "apache 2 0", "apache org licenses license 2 0"),
    ("mit", "mit licen[sc]e|expat licen[sc]e|x11 licen[sc]e", "", "mit", "opensource org licenses mit(?: license)?"),
    ("bsd-2-clause", "simplified bsd licen[sc]e|2 clause bsd licen[sc]e|bsd 2 clause(?: licen[sc]e)?|freebsd licen[sc]e", "", "bsd 2 clause", "opensource org licenses bsd 2 clause"),
    ("bsd-3-clause", "(?:new|revised|modified) bsd licen[sc]e|3 clause bsd licen[sc]e|bsd 3 clause(?: licen[sc]e)?", "", "bsd 3 clause", "opensource org licenses bsd 3 clause"),
    ("bsd-4-clause", "(?:original|old) bsd licen[sc]e|4 clause bsd licen[sc]e|bsd 4 clause(?: licen[sc]e)?", "", "bsd 4 clause", "directory fsf org wiki license bsd 4clause"),
    ("0bsd", "zero clause bsd licen[sc]e|bsd zero clause licen[sc]e", "", "0bsd", "opensource org licenses 0bsd"),
    ("isc", "isc licen[sc]e", "", "isc", "opensource org licenses isc(?: license)?"),
    ("zlib", "zlib(?: libpng)? licen[sc]e", "", "zlib", "opensource org licenses zlib(?: license)?"),
    ("mpl-1.1", "mozilla public licen[sc]e", "1 [01]", "mpl 1 1", "mozilla org mpl mpl 1 1"),
    ("mpl-2.0", "mozilla public licen[sc]e", "2(?: 0)?", "mpl 2 0", "mozilla org (?:en us )?mpl 2 0"),
    ("epl-1.0", "eclipse public licen[sc]e", "1(?: 0)?", "epl 1 0", "eclipse org legal epl v10"),
    ("epl-2.0", "eclipse public licen[sc]e", "2(?: 0)?", "epl 2 0", "eclipse org legal epl (?:2 0|v20)"),
    ("cddl-1.0", "common development and distribution licen[sc]e|cddl", "1 [01]", "cddl 1 0", "opensource org licenses cddl(?: 1 0)?"),
    ("cpl-1.0", "common public licen[sc]e", "1(?: 0)?", "cpl 1 0", "opensource org licenses cpl1 0"),
    ("ipl-1.0", "ibm public licen[sc]e", "1(?: 0)?", "ipl 1 0", "opensource org licenses ipl(?: 1 0)?"),
    ("artistic-1.0", "artistic licen[sc]e", "1(?: 0)?", "artistic 1 0", "opensource org licenses artistic license 1 0"),
    ("artistic-2.0", "artistic licen[sc]e", "2(?: 0)?", "artistic 2 0", "opensource org licenses artistic license 2 0"),
    ("bsl-1.0", "boost software licen[sc]e", "1(?: 0)?", "bsl 1 0", "boost org license 1 0"),
    ("python-2.0", "python (?:software foundation )?licen[sc]e", "2(?: 0)?", "python 2 0", "python org (?:psf )?license"),
    ("php-3.01", "php licen[sc]e", "3(?: 01)?", "php 3 01", "php net license 3 01"),
    ("postgresql", "postgresql licen[sc]e", "", "postgresql", "postgresql org about licen[sc]e"),
    ("ncsa", "university of illinois ncsa open source licen[sc]e|ncsa licen[sc]e", "", "ncsa", "opensource org licenses (?:uoi )?ncsa"),
    ("wtfpl", "do what the fuck you want to public licen[sc]e|wtfpl", "2(?: 0)?", "wtfpl", "wtfpl net"),
    ("unlicense", "the unlicense", "", "unlicense", "unlicense org"),
    ("eupl-1.2", "european union public licen[sc]e|eupl", "1 [12]", "eupl 1 2", "joinup ec europa eu software page eupl"),
    ("osl-3.0", "open software licen[sc]e", "3(?: 0)?", "osl 3 0", "opensource org licenses osl 3 0"),
    ("afl-3.0", "academic free licen[sc]e", "3(?: 0)?", "afl 3 0", "opensource org licenses afl 3 0"),
    ("ms-pl", "microsoft public licen[sc]e|ms pl", "", "ms pl", "opensource org licenses ms pl"),
    ("ms-rl", "microsoft reciprocal licen[sc]e|ms rl", "", "ms rl", "opensource org licenses ms rl"),
    ("ofl-1.1", "sil open font licen[sc]e|open font licen[sc]e", "1 [01]", "ofl 1 1", "scripts sil org ofl"),
    ("odbl-1.0", "open database licen[sc]e|odbl", "1(?: 0)?", "odbl 1 0", "opendatacommons org licenses odbl(?: 1 0)?"),
    ("odc-by-1.0", "open data commons attribution licen[sc]e|odc by", "1(?: 0)?", "odc by 1 0", "opendatacommons org licenses by(?: 1 0)?"),
    ("pddl-1.0", "public domain dedication and licen[sc]e|pddl", "1(?: 0)?", "pddl 1 0", "opendatacommons org licenses pddl(?: 1 0)?"),
    ("cc0-1.0", "cc0|cc zero|creative commons zero", "1(?: 0)?(?: universal)?", "cc0 1 0", "creativecommons org publicdomain zero(?: 1 0)?"),
    ("cc-by", "cc by|creative commons attribution", "[1-4] [05]", "cc by [1-4] [05]", "creativecommons org licenses by(?: [1-4] [05])?"),
    ("cc-by-sa", "cc by sa|creative commons attribution share ?alike", "[1-4] [05]", "cc by sa [1-4] [05]", "creativecommons org licenses by sa(?: [1-4] [05])?"),
    ("cc-by-nd", "cc by nd|creative commons attribution no ?deriv(?:ative)?s", "[1-4] [05]", "cc by nd [1-4] [05]", "creativecommons org licenses by nd(?: [1-4] [05])?"),
    ("cc-by-nc", "cc by nc|creative commons attribution non ?commercial", "[1-4] [05]", "cc by nc [1-4] [05]", "creativecommons org licenses by nc(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc by nc sa|creative commons attribution non ?commercial share ?alike", "[1-4] [05]", "cc by nc sa [1-4] [05]", "creativecommons org licenses by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s", "[1-4] [05]", "cc by nc nd [1-4] [05]", "creativecommons org licenses by nc nd(?: [1-4] [05])?"),
)

#: Notices that name no license text of the table: label, regex.
NOTICES = (
    ("all-rights-reserved", "all rights reserved"),
    ("public-domain", "(?:in|into|to) the public domain"),
    ("copyright-notice", "copyright (?:c )?(?:19|20)[0-9]{2}"),
    ("proprietary", "(?:proprietary and confidential|unauthorized copying (?:of this file )?(?:is )?(?:strictly )?prohibited)"),
    ("non-commercial", "for non ?commercial (?:use|purposes) only"),
    ("permission-notice", "permission is hereby granted free of charge"),
    ("redistribution-notice", "redistribution and use in source and binary forms"),
)

_GRANT = "(?:licen[sc]ed|released|distributed|published|available|redistributed|provided) (?:only )?under "
_TERMS = "(?:the )?(?:terms (?:and conditions )?of )?(?:the |an? )?"
_VERSION = "(?: licen[sc]e)?(?: version| v| ver)? ?"

#: A text without any of these (lower-cased) has neither a base phrase nor a detection.
KEYWORDS = ("licen", "bsd", "copyright", "gpl", "spdx", "public domain", "publicdomain", "creative commons", "creativecommons",
            "gfdl", "cddl", "odbl", "pddl", "wtfpl", "eupl", "odc by", "ms pl", "ms rl", "mozilla org", "eclipse org", "sil org", "joinup",
            "rights reserved", "proprietary", "unauthorized", "commercial", "hereby granted", "redistribution")


@dataclass(frozen=True)
class Rule:
    """``keyword``: a literal that stands in the words of every match."""

    label: str
    kind: str
    keyword: str
    pattern: str
    priority: int
    weight: float


def _rules() -> tuple[Rule, ...]:
    """Five signatures a license (tag, address, grant, versioned name, bare
    name) and the notices, in the order that ties are resolved in."""
    found = []
    for label, names, version, tag, address in LICENSES:
        name = f"(?:{names})"
        versioned = f"{name}{_VERSION}{version}(?: or (?:any )?later(?: version)?)?" if version else name
        found.append(Rule(label, "tag", "spdx", f"spdx license identifier {tag}(?: only| or later)?", 50, 1.0))
        found.append(Rule(label, "address", address.split(" ")[0], f"(?:https? )?(?:www )?{address}", 40, 0.95))
        found.append(Rule(label, "grant", "under", f"{_GRANT}{_TERMS}{versioned}", 30, 1.0))
        if version:
            found.append(Rule(label, "versioned", version[0] if version[0].isdigit() else "", versioned, 20, 0.9))
        else:
            found.append(Rule(label, "named", "", f"(?:the )?{name}", 20, 0.8))
        family = label.rstrip("0123456789.").rstrip("-")
        found.append(Rule(family, "family", "", name, 10, 0.7))
    for label, pattern in NOTICES:
        found.append(Rule(label, "notice", "", pattern, 5, 0.3))
    return tuple(dict.fromkeys(found))


RULES = _rules()
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # of a text whose A-Z are lower-cased
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # of any text
_MARK = "\u0001"  # is a gap, so it stands in no word
_CHUNK = 256


def _whole(pattern: str) -> str:
    return f"(?<= )({pattern})(?= )"


def _table(rules) -> Column:
    return F.array(*(
        F.struct(F.lit(i).alias("rule"), F.lit(r.label).alias("label"), F.lit(r.keyword).alias("keyword"), F.lit(_whole(r.pattern)).alias("pattern"),
                 F.lit(r.priority).alias("priority"), F.lit(float(r.weight)).alias("weight"))
        for i, r in enumerate(rules)
    ))


def _detections(norm: Column, rule: Column) -> Column:
    """The rule's matches in ``norm`` (blank, words joined by blanks, blank):
    the first word of each is marked, so its place among the words is its
    start; the k-th mark and the k-th matched string belong together."""
    found = F.regexp_extract_all(norm, rule["pattern"], F.lit(1))
    marked = F.split(F.trim(F.regexp_replace(norm, rule["pattern"], F.lit(_MARK + "$1"))), " ")
    starts = F.transform(
        F.filter(F.transform(marked, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: F.startswith(x["w"], F.lit(_MARK))), lambda x: x["i"]
    )
    spans = F.zip_with(
        starts, found,
        lambda start, text: let(
            start + F.size(F.split(text, " ")),
            lambda end: F.struct(start.alias("start"), (-end).alias("before"), (-rule["priority"]).alias("order"), rule["rule"].alias("rule"),
                                 end.alias("end"), rule["label"].alias("label"), rule["weight"].alias("weight")),
        ),
    )
    return F.when(F.rlike(norm, rule["pattern"]), spans)


def _uncontained(spans: Column) -> Column:
    """Spans in order of start, longer first, then priority; one is kept if it
    ends beyond every span before it.  In pieces, so that a text with very many
    spans costs a pass over them and not their square."""

    def by_piece(s: Column) -> Column:
        pieces = F.when(F.size(s) == 0, F.array(s)).otherwise(
            F.transform(F.sequence(F.lit(0), ((F.size(s) - 1) / _CHUNK).cast("int")), lambda c: F.slice(s, c * _CHUNK + 1, _CHUNK))
        )

        def ends(x: Column) -> Column:
            return F.coalesce(F.array_max(F.transform(x, lambda y: y["end"])), F.lit(-1))

        def kept(ps: Column) -> Column:
            return let(
                F.transform(ps, ends),
                lambda tops: F.flatten(F.transform(
                    ps,
                    lambda p, c: let(
                        F.coalesce(F.array_max(F.slice(tops, 1, c)), F.lit(-1)),
                        lambda top: F.filter(p, lambda x, i: (x["end"] > top) & (x["end"] > ends(F.slice(p, 1, i)))),
                    ),
                )),
            )

        return let(pieces, kept)

    return let(F.sort_array(spans), by_piece)


def scan(docs: DataFrame, text_col: str = "text", out: str = "license", rules=RULES) -> DataFrame:
    """``docs`` with a struct ``out``: ``n_words``, ``base`` (start and label of
    each place of a base phrase, by start), ``spans`` (start, end, label, rule,
    weight of each detection that is not suppressed; words from 0, end
    exclusive)."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))

    def gate(low: Column) -> Column:
        hit = low.contains("cc") & low.rlike("cc[^0-9a-z]+(?:by|zero)|cc0")
        for k in KEYWORDS:
            # keywords of several words may be parted by any gap
            hit = hit | (low.contains(k) if " " not in k else low.contains(k.split(" ")[0]) & low.rlike(k.replace(" ", "[^0-9a-z]+")))
        return hit

    hit = let(F.lower(text), gate)  # lower-cased once for all the keywords
    norm = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.translate(text, _UPPER, _LOWER), _GAP, " ")), F.lit(" "))
    base_rules = _table([Rule(label, "base", phrase, phrase, 0, 1.0) for phrase, label in BASE])

    def spans(n: Column, table: Column) -> Column:
        gated = F.filter(table, lambda r: (r["keyword"] == "") | F.contains(n, r["keyword"]))
        return F.flatten(F.filter(F.transform(gated, lambda r: _detections(n, r)), lambda x: x.isNotNull()))

    def shaped(xs: Column) -> Column:
        return F.transform(xs, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["label"].alias("label"), x["rule"].alias("rule"), x["weight"].alias("weight")))

    found = let(norm, lambda n: F.struct(shaped(F.sort_array(spans(n, base_rules))).alias("base"), shaped(_uncontained(spans(n, _table(rules)))).alias("spans")))
    kind = "array<struct<start:int,end:int,label:string,rule:int,weight:double>>"
    none = F.struct(F.array().cast(kind).alias("base"), F.array().cast(kind).alias("spans"))
    return docs.withColumn(out, let(
        F.when(hit, found).otherwise(none),
        lambda f: F.struct(F.regexp_count(text, F.lit(_WORD)).cast("long").alias("n_words"), f["base"].alias("base"), f["spans"].alias("spans")),
    ))


def labels(spans: Column) -> Column:
    """Distinct labels of spans, sorted, comma-joined."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda x: x["label"]))), ",")
