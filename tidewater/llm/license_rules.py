"""License scans with ordered signature rules (operator 12), DataFrame functions
only.

A text becomes its words, A-Z lowered, each between two blanks of its own. Rules
are regular expressions over words, written as in ``<under>(<the>)?<mit>
<licen[cs]e>``: what stands in <> is one word. Every rule has a keyword, a word or
the beginning of one, that each of its matches contains. One pattern of all keywords
lets most texts pass by; the others' rules are those whose keyword they contain. All places
of all matching rules are detections with an interval, a priority and a rule.
A detection is suppressed when another one of the same or a higher priority
contains its interval ("general public license version 3" inside "gnu lesser
general public license version 3"); of equal intervals of one priority the
earlier rule's stays. The base rules' labels stay in any case.

Everything is row by row: no shuffle, no join, no Python. Suppression is one fold
over the detections in order of their start with the furthest end seen for each
priority as its state. Places are running sums taken in two levels, so a text
with many matches doesn't copy a growing array for each.

Null and empty texts have no words, empty labels, null places and score 0.
Repeated rows and null ids are rows like any other; columns other than doc_id
and text are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import whole_text

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Priorities, the strongest first: identifiers and grants, the wording of a
#: license or its address, its mere name.
GRANT, WORDING, NAME = 0, 1, 2
WEIGHTS = {GRANT: 1.0, WORDING: 0.9, NAME: 0.6}
#: Running sums go over this many matches at a time, then over the sums.
CHUNK = 256


class Rule(NamedTuple):
    label: str
    keyword: str
    pattern: str
    priority: int
    base: bool = False

    @property
    def regex(self) -> str:
        return as_regex(self.pattern)

    @property
    def start(self) -> str:
        """The keyword as it begins a word of each match, with a blank behind it
        where it is the whole word."""
        whole = f"<{self.keyword}>" in self.pattern and f"<{self.keyword}v?" not in self.pattern
        return f"{self.keyword} " if whole else self.keyword


def as_regex(pattern: str) -> str:
    """``<x>`` is one word between its blanks; ``x`` may be an alternation."""
    return re.sub(r"<([^<>]+)>", lambda m: f"(?: (?:{m[1]}) )" if "|" in m[1] else f"(?: {m[1]} )",
                  pattern)


# The phrases every scan must find, and their labels.
BASE = (("mit", "mit", "<under><the><mit><license>"),
        ("apache-2", "apache", "<apache><license><version><2>"),
        ("cc-by-nc", "cc", "<cc><by><nc>"))

_L = "<licen[cs]e>"
_V = "(<version>|<v>)?"
_LATER = "(<only>|<or>(<at><your><option>)?(<any>)?<later>(<version>)?)?"


def _versioned(label: str, keyword: str, name: str, short: str, version: str) -> tuple:
    """A license of one name in several versions, with its short name; '2.0' is
    two words."""
    words = "".join(f"<{w}>" for w in version.split("."))
    if version.endswith(".0"):
        words = f"<{version[:-2]}>(<0>)?"
    joined = f"<{short}v?{version.split('.')[0]}>" + "".join(
        f"<{w}>" if w != "0" else "(<0>)?" for w in version.split(".")[1:])
    compact = f"(<gnu>)?(<{short}>(<{'v' + version.split('.')[0]}>|{_V}<{version.split('.')[0]}>)" + "".join(
        f"<{w}>" if w != "0" else "(<0>)?" for w in version.split(".")[1:]) + f"|{joined})"
    return ((f"{label}", keyword, f"{name}{_V}{words}"), (f"{label}", short, compact))


_CC = "<creative><commons>"


def _creative(label: str, long: str, short: str) -> tuple:
    """A creative commons license by its long name, its short one and its address."""
    return ((label, "creative", f"{_CC}{long}(<\\d>)?(<\\d>)?(<international>|<unported>|<generic>)?({_L})?"),
            (label, "cc", f"<cc>{short}(<\\d>)?(<\\d>)?"))


# Names: (label, keyword, pattern). Each gives a rule for the name, one for a
# grant under it and one for an identifier line.
NAMES: tuple[tuple[str, str, str], ...] = (
    ("mit", "mit", f"<mit>(<x11>)?({_L}|<licensed>)"),
    ("mit", "expat", f"<expat>{_L}"),
    ("mit-0", "mit", f"<mit>(<no><attribution>|<0>)({_L})?"),
    ("x11", "x11", f"<x11>{_L}"),
    ("isc", "isc", f"<isc>{_L}"),
    ("0bsd", "bsd", f"(<0><bsd>|<zero><clause><bsd>|<bsd><zero><clause>)({_L})?"),
    ("0bsd", "0bsd", f"<0bsd>({_L})?"),
    ("bsd", "bsd", f"<bsd>(<style>)?{_L}"),
    ("bsd-2", "bsd", f"(<bsd><2>|<2><clause><bsd>|<two><clause><bsd>|<bsd><two>|<simplified><bsd>)"
                     f"(<clause>)?({_L})?"),
    ("bsd-2", "freebsd", f"<freebsd>{_L}"),
    ("bsd-3", "bsd", f"(<bsd><3>|<3><clause><bsd>|<three><clause><bsd>|<bsd><three>|<new><bsd>|<modified><bsd>"
                     f"|<revised><bsd>)(<clause>)?({_L})?"),
    ("bsd-4", "bsd", f"(<bsd><4>|<4><clause><bsd>|<four><clause><bsd>|<bsd><four>|<original><bsd>)"
                     f"(<clause>)?({_L})?"),
    ("apache-1", "apache", f"<apache>(<software>)?{_L}{_V}<1>(<0>)?"),
    ("apache-1.1", "apache", f"<apache>(<software>)?{_L}{_V}<1><1>"),
    ("apache-2", "apache", f"<apache>(<software>)?({_L})?{_V}<2>(<0>)?"),
    ("apache", "apache", f"<apache>(<software>|<public>)?{_L}"),
    *_versioned("gpl-1", "general", "(<gnu>)?<general><public>" + _L, "gpl", "1.0"),
    *_versioned("gpl-2", "general", "(<gnu>)?<general><public>" + _L, "gpl", "2.0"),
    *_versioned("gpl-3", "general", "(<gnu>)?<general><public>" + _L, "gpl", "3.0"),
    ("gpl", "general", f"<gnu><general><public>{_L}"),
    ("gpl", "gpl", "<gnu><gpl>"),
    *_versioned("lgpl-2", "general", "(<gnu>)?<library><general><public>" + _L, "lgpl", "2.0"),
    *_versioned("lgpl-2.1", "general", "(<gnu>)?<lesser><general><public>" + _L, "lgpl", "2.1"),
    *_versioned("lgpl-3", "general", "(<gnu>)?<lesser><general><public>" + _L, "lgpl", "3.0"),
    ("lgpl", "general", f"(<gnu>)?(<lesser>|<library>)<general><public>{_L}"),
    ("lgpl", "lgpl", "<gnu><lgpl>"),
    *_versioned("agpl-3", "general", "(<gnu>)?<affero><general><public>" + _L, "agpl", "3.0"),
    ("agpl", "general", f"(<gnu>)?<affero><general><public>{_L}"),
    *_versioned("gfdl-1.2", "documentation", "(<gnu>)?<free><documentation>" + _L, "gfdl", "1.2"),
    *_versioned("gfdl-1.3", "documentation", "(<gnu>)?<free><documentation>" + _L, "gfdl", "1.3"),
    ("gfdl", "documentation", f"(<gnu>)?<free><documentation>{_L}"),
    *_versioned("mpl-1.1", "mozilla", "<mozilla><public>" + _L, "mpl", "1.1"),
    *_versioned("mpl-2", "mozilla", "<mozilla><public>" + _L, "mpl", "2.0"),
    ("mpl", "mozilla", f"<mozilla><public>{_L}"),
    *_versioned("epl-1", "eclipse", "<eclipse><public>" + _L, "epl", "1.0"),
    *_versioned("epl-2", "eclipse", "<eclipse><public>" + _L, "epl", "2.0"),
    ("epl", "eclipse", f"<eclipse><public>{_L}"),
    *_versioned("cddl-1", "distribution", "<common><development><and><distribution>" + _L, "cddl", "1.0"),
    ("cddl", "distribution", f"<common><development><and><distribution>{_L}"),
    ("cpl-1", "common", f"<common><public>{_L}({_V}<1>(<0>)?)?"),
    *_versioned("eupl-1.1", "european", "<european><union><public>" + _L, "eupl", "1.1"),
    *_versioned("eupl-1.2", "european", "<european><union><public>" + _L, "eupl", "1.2"),
    ("eupl", "european", f"<european><union><public>{_L}"),
    *_versioned("osl-3", "open", "<open><software>" + _L, "osl", "3.0"),
    *_versioned("afl-3", "academic", "<academic><free>" + _L, "afl", "3.0"),
    *_versioned("artistic-1", "artistic", "<artistic>" + _L, "artistic", "1.0"),
    *_versioned("artistic-2", "artistic", "<artistic>" + _L, "artistic", "2.0"),
    ("artistic", "artistic", f"<artistic>{_L}"),
    ("bsl-1", "boost", f"<boost><software>{_L}({_V}<1>(<0>)?)?"),
    ("busl-1.1", "business", f"<business><source>{_L}({_V}<1><1>)?"),
    ("sspl-1", "server", f"<server><side><public>{_L}({_V}<1>(<0>)?)?"),
    ("elastic-2", "elastic", f"<elastic>{_L}({_V}<2>(<0>)?)?"),
    ("zlib", "zlib", f"<zlib>(<libpng>)?{_L}"),
    ("libpng", "libpng", f"<libpng>{_L}"),
    ("wtfpl", "wtfpl", f"<wtfpl>({_L})?"),
    ("unlicense", "unlicense", "(<the>)?<unlicense>"),
    ("python-2", "python", f"<python>(<software><foundation>)?{_L}({_V}<2>(<0>)?)?"),
    ("ruby", "ruby", f"<ruby>{_L}"),
    ("php-3", "php", f"<php>{_L}({_V}<3>(<0>|<01>)?)?"),
    ("perl", "perl", "<same><terms><as><perl>(<itself>|<5>)?"),
    ("postgresql", "postgresql", f"<postgresql>{_L}"),
    ("openssl", "openssl", f"<openssl>{_L}"),
    ("ncsa", "ncsa", f"(<university><of><illinois>)?<ncsa>(<open><source>)?{_L}"),
    ("ms-pl", "microsoft", f"<microsoft><public>{_L}"),
    ("ms-rl", "microsoft", f"<microsoft><reciprocal>{_L}"),
    ("ecl-2", "educational", f"<educational><community>{_L}({_V}<2>(<0>)?)?"),
    ("upl-1", "universal", f"<universal><permissive>{_L}({_V}<1>(<0>)?)?"),
    ("ofl-1.1", "font", f"<sil><open><font>{_L}({_V}<1><1>)?"),
    ("ofl-1.1", "ofl", "<sil><ofl>(<1><1>)?"),
    ("odbl-1", "database", f"<open><database>{_L}({_V}<1>(<0>)?)?"),
    ("odbl-1", "odbl", f"<odbl>({_L})?"),
    ("pddl-1", "domain", f"<public><domain><dedication><and>{_L}"),
    ("odc-by-1", "data", f"<open><data><commons><attribution>({_L})?"),
    ("ogl-3", "government", f"<open><government><licence>{_V}<3>(<0>)?"),
    ("ogl", "government", f"<open><government><licence>"),
    ("cc0", "cc0", f"<cc0>(<1>(<0>)?)?(<universal>)?({_L})?"),
    ("cc0", "creative", f"{_CC}<zero>(<1>(<0>)?)?"),
    *_creative("cc-by", "<attribution>", "<by>"),
    *_creative("cc-by-sa", "<attribution>(<share><alike>|<sharealike>)", "<by><sa>"),
    *_creative("cc-by-nd", "<attribution>(<no>(<derivatives>|<derivs>)|<noderivatives>|<noderivs>)", "<by><nd>"),
    *_creative("cc-by-nc", "<attribution>(<non><commercial>|<noncommercial>)", "<by><nc>"),
    *_creative("cc-by-nc-sa", "<attribution>(<non><commercial>|<noncommercial>)(<share><alike>|<sharealike>)",
               "<by><nc><sa>"),
    *_creative("cc-by-nc-nd", "<attribution>(<non><commercial>|<noncommercial>)"
               "(<no>(<derivatives>|<derivs>)|<noderivatives>|<noderivs>)", "<by><nc><nd>"),
    ("cc", "creative", f"{_CC}({_L})?"),
    ("openrail", "rail", f"(<creativeml>)?<open><rail>(<m>|<s>)?({_L})?"),
    ("openrail", "openrail", f"(<creativeml>|<bigscience>)?<openrail>(<m>|<s>)?({_L})?"),
    ("community-model", "community", f"<community>{_L}<agreement>"),
    ("beerware", "beerware", f"<beerware>({_L})?"),
    ("vim", "vim", f"<vim>{_L}"),
    ("latex-1.3", "latex", f"<latex><project><public>{_L}({_V}<1>(<3>|<3c>)?)?"),
    ("cecill-2.1", "cecill", f"<cecill>({_L})?({_V}<2>(<1>)?)?"),
    ("mulan-2", "mulan", f"<mulan>(<permissive><software>{_L}|<psl>)({_V}<2>(<0>)?|<v2>)?"),
    ("proprietary", "commercial", f"<commercial>{_L}(<agreement>)?"),
    ("proprietary", "proprietary", f"<proprietary>({_L}|<software>|<and><confidential>)"),
    ("proprietary", "agreement", f"<end><user>{_L}<agreement>"),
)

#: Wording and addresses: (label, keyword, pattern).
WORDINGS: tuple[tuple[str, str, str], ...] = (
    ("mit", "permission", "<permission><is><hereby><granted><free><of><charge><to><any><person><obtaining><a><copy>"),
    ("mit", "opensource", "<opensource><org><licenses><mit>"),
    ("isc", "permission", "<permission><to><use><copy><modify><and><or><distribute><this><software>"),
    ("bsd", "redistribution", "<redistribution><and><use><in><source><and><binary><forms>"),
    ("bsd-3", "endorse", "<used><to><endorse><or><promote><products><derived><from>"),
    ("bsd-2", "opensource", "<opensource><org><licenses><bsd><2><clause>"),
    ("bsd-3", "opensource", "<opensource><org><licenses><bsd><3><clause>"),
    ("apache-2", "apache", "<apache><org><licenses><license><2><0>"),
    ("apache-2", "permissions", "<governing><permissions><and><limitations><under><the><license>"),
    ("gpl-2", "gnu", "<gnu><org><licenses>(<old><licenses>)?<gpl><2><0>"),
    ("gpl-3", "gnu", "<gnu><org><licenses><gpl><3><0>"),
    ("gpl", "gnu", "<gnu><org><licenses><gpl>"),
    ("lgpl-2.1", "gnu", "<gnu><org><licenses>(<old><licenses>)?<lgpl><2><1>"),
    ("lgpl-3", "gnu", "<gnu><org><licenses><lgpl><3><0>"),
    ("agpl-3", "gnu", "<gnu><org><licenses><agpl><3><0>"),
    ("gfdl", "gnu", "<gnu><org><licenses><fdl>"),
    ("gpl-2", "foundation", "<free><software><foundation><either><version><2>"),
    ("gpl-3", "foundation", "<free><software><foundation><either><version><3>"),
    ("mpl-2", "mozilla", "<mozilla><org><mpl><2><0>"),
    ("mpl-2", "mozilla", "<source><code><form><is><subject><to><the><terms><of><the><mozilla><public><license>"),
    ("epl-2", "eclipse", "<eclipse><org><legal><epl><2><0>"),
    ("epl-1", "eclipse", "<eclipse><org><legal><epl><v10>"),
    ("bsl-1", "boost", "<boost><org><license><1><0>"),
    ("zlib", "misrepresented", "<origin><of><this><software><must><not><be><misrepresented>"),
    ("unlicense", "unencumbered", "<free><and><unencumbered><software><released><into><the><public><domain>"),
    ("unlicense", "unlicense", "<unlicense><org>"),
    ("wtfpl", "fuck", "<do><what><the><fuck><you><want><to>"),
    ("cc0", "creativecommons", "<creativecommons><org><publicdomain><zero>"),
    ("cc-by", "creativecommons", "<creativecommons><org><licenses><by>"),
    ("cc-by-sa", "creativecommons", "<creativecommons><org><licenses><by><sa>"),
    ("cc-by-nd", "creativecommons", "<creativecommons><org><licenses><by><nd>"),
    ("cc-by-nc", "creativecommons", "<creativecommons><org><licenses><by><nc>"),
    ("cc-by-nc-sa", "creativecommons", "<creativecommons><org><licenses><by><nc><sa>"),
    ("cc-by-nc-nd", "creativecommons", "<creativecommons><org><licenses><by><nc><nd>"),
    ("ofl-1.1", "sil", "<scripts><sil><org><ofl>"),
    ("artistic-2", "artistic", "<perlfoundation><org><artistic>(<license>)?<2>"),
    ("ncsa", "opensource", "<opensource><org><licenses><ncsa>"),
    ("isc", "opensource", "<opensource><org><licenses><isc>"),
    ("public-domain", "domain", "(<released>|<dedicated>|<placed>)(<in>|<into>|<to>)<the><public><domain>"),
    ("public-domain", "domain", "<is><in><the><public><domain>"),
    ("all-rights-reserved", "reserved", "<all><rights><reserved>"),
    ("no-redistribution", "reproduced", "<may><not><be><reproduced>"),
    ("no-redistribution", "permission", "<without>(<the>)?(<prior>)?(<express>)?<written><permission>"),
    ("no-redistribution", "prohibited", "<unauthorized>(<copying>|<use>|<distribution>|<reproduction>)(<\\w+>)?"
                                        "(<\\w+>)?<prohibited>"),
    ("proprietary", "confidential", "<proprietary><and><confidential>"),
    ("non-commercial", "commercial", "(<for>)?<non><commercial>(<use>|<purposes>)(<only>)?"),
    ("research-only", "research", "<for><research>(<and><educational>)?<purposes><only>"),
)

_VERB = "<licensed|released|distributed|available|published|provided|licence|redistribute|use>"
_GRANT = f"{_VERB}(<it>)?(<and><or><modify>(<it>)?)?<under>(<the><terms><of>)?(<the>|<a>|<an>)?"


def _rules() -> tuple[Rule, ...]:
    out = [Rule(label, word, pattern, GRANT, True) for label, word, pattern in BASE]
    out += [Rule(label, word, f"{_GRANT}{name}{_LATER}", GRANT) for label, word, name in NAMES]
    out += [Rule(label, "spdx", f"<spdx>{_L}<identifier>{name}{_LATER}", GRANT)
            for label, word, name in NAMES if f"({_L})?" in name or _V in name]
    out += [Rule(label, word, pattern, WORDING) for label, word, pattern in WORDINGS]
    out += [Rule(label, word, f"{name}{_LATER}", NAME) for label, word, name in NAMES]
    return tuple(out)


#: The rules in their order; of equals, the earlier one counts.
RULES = _rules()


def gate(rules: Sequence[Rule]) -> str:
    """The prefilter: a pattern that every text with a match of any rule has,
    its keywords grouped by their first letter."""
    by_first: dict[str, list[str]] = {}
    for word in sorted({r.start for r in rules}):
        by_first.setdefault(word[0], []).append(re.escape(word[1:]).replace("\\ ", " "))
    return " (?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in by_first.items()) + ")"


def words_of(text: Column) -> Column:
    """The words of a text, each between two blanks; '' without words. ``lower`` is
    much faster than a translation; it changes other letters too, but of those
    only the Kelvin sign becomes a letter that a rule can name."""
    low = F.when(text.contains("\u212a"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))
    flat = F.trim(F.regexp_replace(low, NOT_WORD, "  "))
    return F.when(flat == "", F.lit("")).otherwise(F.concat(F.lit(" "), flat, F.lit(" ")))


def _words_in(piece: Column) -> Column:
    return (F.length(piece) - F.length(F.replace(piece, F.lit(" "), F.lit("")))) / 2


def _starts(lengths: Column) -> Column:
    """Running sums before each element, for arrays of any length."""
    n = F.size(lengths)

    def before(items: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(items, start, lambda s, x: F.struct(
            (s["at"] + x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")))

    cuts = F.sequence(F.lit(0), F.floor((n - 1) / CHUNK).cast("int"))
    parts = F.transform(cuts, lambda c: before(F.slice(lengths, c * CHUNK + 1, F.lit(CHUNK))))
    totals = before(F.transform(parts, lambda p: p["at"]))["out"]
    return F.when(n > 0, F.flatten(F.zip_with(parts, totals, lambda p, t: F.transform(
        p["out"], lambda x: x + t)))).otherwise(F.array().cast("array<int>"))


def _found(words: Column, rule: Column) -> Column:
    """The detections of one rule: (start, less, priority, rule), places in words;
    ``less`` is minus the end."""
    pairs = F.zip_with(
        F.transform(F.split(words, rule["regex"], F.lit(-1)), lambda g: _words_in(g).cast("int")),
        F.transform(F.regexp_extract_all(words, rule["regex"], F.lit(0)),
                    lambda h: _words_in(h).cast("int")),
        lambda gap, hit: F.struct(gap.alias("gap"), F.coalesce(hit, F.lit(0)).alias("hit")))
    # words before match k: gaps up to its own and the matches before it
    return F.get(F.transform(F.array(pairs), lambda p: F.zip_with(
        _starts(F.transform(p, lambda x: x["gap"] + x["hit"])), p,
        lambda at, x: F.struct((at + x["gap"]).alias("start"),
                               (-(at + x["gap"] + x["hit"])).alias("less"),
                               rule["priority"].alias("priority"),
                               rule["rule"].alias("rule"), x["hit"].alias("size")))), F.lit(0))


def _table(rules: Sequence[Rule]) -> Column:
    return F.array(*[F.struct(
        F.lit(k).alias("rule"), F.lit(r.label).alias("label"), F.lit(f" {r.start}").alias("keyword"),
        F.lit(r.regex).alias("regex"), F.lit(r.priority).alias("priority")) for k, r in enumerate(rules)])


def _surviving(found: Column, priorities: int) -> Column:
    """The detections that none of the same or a higher priority contains."""
    ends = F.array(*[F.lit(0)] * priorities)
    start = F.struct(ends.alias("ends"), F.array().cast("array<int>").alias("rules"))

    def step(s: Column, d: Column) -> Column:
        reach = F.array_max(F.slice(s["ends"], F.lit(1), d["priority"] + 1))
        return F.struct(
            F.transform(s["ends"], lambda e, p: F.when(
                p == d["priority"], F.greatest(e, -d["less"])).otherwise(e)).alias("ends"),
            F.when(reach >= -d["less"], s["rules"])
            .otherwise(F.array_union(s["rules"], F.array(d["rule"]))).alias("rules"))

    return F.aggregate(F.sort_array(found), start, step, lambda s: s["rules"])


def scan_licenses(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word
    (of the base rules' places, from 0), base_labels, labels (comma-joined),
    score (weight of the strongest surviving detection) and ``detections``, an
    array of (start, end, rule) of every rule's places, in order."""
    n_base = sum(r.base for r in rules)
    if any(not r.base for r in rules[:n_base]):
        raise ValueError("base rules come first")
    table = _table(rules)
    label = F.array(*[F.lit(r.label) for r in rules])
    weight = F.array(*[F.lit(WEIGHTS[r.priority]) for r in rules])
    words = F.col("words")
    keywords = sorted({f" {r.start}" for r in rules})
    present = F.filter(F.array(*[F.lit(k) for k in keywords]), lambda k: F.contains(F.col("words"), k))
    # most rules of a keyword match nowhere, which one search tells
    chosen = F.filter(table, lambda r: F.array_contains(F.col("present"), r["keyword"])
                      & F.rlike(F.col("words"), r["regex"]))
    found = F.filter(F.flatten(F.transform(chosen, lambda r: _found(F.col("words"), r))),
                     lambda d: d["size"] > 0)
    none = F.array().cast("array<struct<start:int,less:int,priority:int,rule:int,size:int>>")
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        words_of(whole_text()).alias("words"))
            .withColumn("present", F.when(words.rlike(gate(rules)), present))
            .withColumn("found", F.when(F.size("present") > 0, found).otherwise(none)))

    base = F.filter("found", lambda d: d["rule"] < n_base)
    places = F.transform(base, lambda d: d["start"])

    def labels(of: Column) -> Column:
        return F.array_sort(F.array_distinct(F.transform(of, lambda k: F.get(label, k))))

    base_rules = F.transform(base, lambda d: d["rule"])
    rows = rows.select("doc_id", _words_in(words).cast("long").alias("n_words"), "found",
                       places.alias("places"), base_rules.alias("base_rules"),
                       F.when(F.size("found") > 0, _surviving(F.col("found"), len(WEIGHTS)))
                       .otherwise(F.array().cast("array<int>")).alias("kept"))
    return rows.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join(labels(F.col("base_rules")), ",").alias("base_labels"),
        F.array_join(labels(F.concat("base_rules", "kept")), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("kept", lambda k: F.get(weight, k))), F.lit(0.0)).alias("score"),
        F.transform(F.sort_array("found"), lambda d: F.struct(
            d["start"].alias("start"), (-d["less"]).alias("end"), d["rule"].alias("rule")))
        .alias("detections"))


def oracle_sql(rules: Sequence[Rule] = RULES) -> str:
    """The query's SQL: every rule against every text, suppression by a
    comparison of each detection with all others of its text."""
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"
    table = ",\n".join(f"({k}, {quoted(r.label)}, {quoted(r.regex)}, {r.priority}, {r.base}, {WEIGHTS[r.priority]})"
                       for k, r in enumerate(rules))
    return rf"""
WITH rules(rule, label, regex, priority, base, weight) AS (VALUES
{table}),
flat AS (
  SELECT row_number() OVER () AS r, doc_id, trim(regexp_replace(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', '  ', 'g'), ' ') AS flat FROM documents),
d AS MATERIALIZED (
  SELECT r, doc_id, CASE WHEN flat = '' THEN '' ELSE ' ' || flat || ' ' END AS words FROM flat),
cut AS MATERIALIZED (
  SELECT r, rule, string_split_regex(words, regex) AS gaps,
         regexp_extract_all(words, regex) AS hits FROM d, rules
  WHERE regexp_matches(words, regex)),
k AS (SELECT r, rule, gaps, hits, unnest(range(1, len(hits) + 1)) AS k FROM cut),
found AS MATERIALIZED (
  SELECT k.r, k.rule, label, priority, base, weight,
         list_sum(list_transform(gaps[1:k.k], lambda x: (length(x) - length(replace(x, ' ', ''))) // 2))
           + coalesce(list_sum(list_transform(hits[1:k.k - 1],
                                              lambda x: (length(x) - length(replace(x, ' ', ''))) // 2)), 0) AS s,
         (length(hits[k.k]) - length(replace(hits[k.k], ' ', ''))) // 2 AS n
  FROM k JOIN rules USING (rule)),
kept AS (
  SELECT * FROM found f WHERE NOT EXISTS (
    SELECT 1 FROM found g WHERE g.r = f.r AND g.priority <= f.priority AND g.s <= f.s
      AND g.s + g.n >= f.s + f.n
      AND (g.s < f.s OR g.s + g.n > f.s + f.n OR (g.priority, g.rule) < (f.priority, f.rule)))),
base AS (
  SELECT r, count(*) AS n_base, min(s) AS first_word, max(s) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM found WHERE base GROUP BY r),
named AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (
    SELECT r, label FROM kept UNION SELECT r, label FROM found WHERE base) GROUP BY r),
scored AS (SELECT r, max(weight) AS score FROM kept GROUP BY r)
SELECT doc_id, CAST((length(words) - length(replace(words, ' ', ''))) // 2 AS BIGINT) AS n_words,
       CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN named USING (r) LEFT JOIN scored USING (r)
"""
