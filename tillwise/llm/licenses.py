"""Licence statements in texts: notice phrases and identifier tags by Aho-Corasick, tag expressions by a
shunting-yard parser.

One automaton runs over the words of a text. It finds the notice phrases and the words of the tag; the
expression after a tag is then read from the raw line. Documents are scanned where they lie, so nothing
is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.common import split_words

# The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further notices that name a licence more closely.
NOTICES = {
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl-3.0",
    "apache license version 2 0": "apache-2.0",
    "cc by 4 0": "cc-by-4.0",
    "cc by sa 4 0": "cc-by-sa-4.0",
    "cc by nc 4 0": "cc-by-nc-4.0",
    "cc by nd 4 0": "cc-by-nd-4.0",
    "cc0 1 0 universal": "cc0-1.0",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "isc license": "isc",
    "the unlicense": "unlicense",
    "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"
TAG_LINE = re.compile(r"SPDX-License-Identifier:[ \t]*([^\r\n]*)", re.IGNORECASE)
TOKEN = re.compile(r"\s*([()]|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
# Identifiers in common use, lower-cased; expressions with any other name are not valid.
IDENTIFIERS = frozenset("""
0bsd afl-3.0 agpl-1.0-only agpl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.0 apache-1.1 apache-2.0 apsl-2.0 artistic-1.0 artistic-2.0
blueoak-1.0.0 bsd-1-clause bsd-2-clause bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear bsd-4-clause bsl-1.0 bzip2-1.0.6
cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0 cc-by-nc-3.0 cc-by-nc-4.0 cc-by-nc-nd-4.0 cc-by-nc-sa-4.0 cc-by-nd-4.0 cc-by-sa-3.0 cc-by-sa-4.0
cc0-1.0 cddl-1.0 cddl-1.1 cecill-2.1 cpl-1.0 curl ecl-2.0 epl-1.0 epl-2.0 eupl-1.1 eupl-1.2 ftl
gfdl-1.3-only gfdl-1.3-or-later gpl-1.0-only gpl-1.0-or-later gpl-2.0 gpl-2.0+ gpl-2.0-only gpl-2.0-or-later gpl-3.0 gpl-3.0+ gpl-3.0-only gpl-3.0-or-later
hpnd icu ijg ipl-1.0 isc json lgpl-2.0-only lgpl-2.0-or-later lgpl-2.1 lgpl-2.1+ lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0 lgpl-3.0+ lgpl-3.0-only lgpl-3.0-or-later
libpng libpng-2.0 lppl-1.3c mit mit-0 mpl-1.0 mpl-1.1 mpl-2.0 ms-pl ms-rl mulanpsl-2.0 ncsa nist-software ofl-1.1 openldap-2.8 openssl osl-3.0
php-3.0 php-3.01 postgresql psf-2.0 python-2.0 ruby sissl sleepycat tcl unicode-3.0 unicode-dfs-2016 unlicense upl-1.0 vim w3c wtfpl x11 zlib zpl-2.1
""".split())
# Names that may stand after `with`.
EXCEPTIONS = frozenset("""
autoconf-exception-2.0 autoconf-exception-3.0 bison-exception-2.2 bootloader-exception classpath-exception-2.0 font-exception-2.0
gcc-exception-2.0 gcc-exception-3.1 libtool-exception linux-syscall-note llvm-exception openjdk-assembly-exception-1.0 qt-gpl-exception-1.0
swift-exception universal-foss-exception-1.0 wxwindows-exception-3.1
""".split())
REFERENCE = re.compile(r"(documentref-[a-z0-9.-]+:)?licenseref-[a-z0-9.-]+")

# How much a licence asks for, from its identifier's first part.
DUTIES = {
    "mit": 1, "bsd": 1, "apache": 1, "isc": 1, "unlicense": 0, "cc0": 0, "0bsd": 0, "zlib": 1, "cc": 1,
    "lgpl": 2, "mpl": 2, "epl": 2, "gpl": 3, "agpl": 4,
}
DUTY_NAMES = ["public-domain", "permissive", "weak-copyleft", "copyleft", "network-copyleft", "unknown"]
UNKNOWN_DUTY = 5


def postfix(expression: str) -> list[str] | None:
    """The expression's identifiers and operators in postfix order; None if it is malformed."""
    tokens, at = [], 0
    expression = expression.split("*/")[0].split("-->")[0].strip()
    while at < len(expression):
        found = TOKEN.match(expression, at)
        if not found:
            return None
        tokens.append(found[1])
        at = found.end()
    out, waiting, operand_due = [], [], True
    for token in tokens:
        name = token.lower()
        if token == "(":
            if not operand_due:
                return None
            waiting.append(token)
        elif token == ")":
            if operand_due:
                return None
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        elif name in PRECEDENCE:
            if operand_due:
                return None
            while waiting and waiting[-1] != "(" and PRECEDENCE[waiting[-1]] >= PRECEDENCE[name]:
                out.append(waiting.pop())
            waiting.append(name)
            operand_due = True
        else:
            if not operand_due:
                return None
            out.append(name)
            operand_due = False
    if operand_due or "(" in waiting:
        return None
    return out + waiting[::-1]


def evaluate(items: list[str]) -> tuple[int, list[str]] | None:
    """(duty, licence identifiers): `and` asks for the most of its sides, `or` for the least, `with` one less.

    The right side of `with` must be an exception's identifier, which is no licence itself; all other names must be
    known identifiers or references to a licence text. An expression with an unknown name has no value.
    """
    stack: list[tuple[int, list[str]]] = []
    for place, item in enumerate(items):
        is_exception = items[place + 1 : place + 2] == ["with"]
        if item not in PRECEDENCE and not (item in EXCEPTIONS if is_exception else item in IDENTIFIERS or REFERENCE.fullmatch(item)):
            return None
    for item in items:
        if item in PRECEDENCE:
            right, left = stack.pop(), stack.pop()
            if item == "with":
                if len(right[1]) != 1 or len(left[1]) != 1:
                    return None
                duty = left[0] - 1 if 1 < left[0] < UNKNOWN_DUTY else left[0]
                stack.append((duty, left[1]))
            else:
                stack.append(((max if item == "and" else min)(left[0], right[0]), left[1] + right[1]))
        else:
            stack.append((DUTIES.get(re.split(r"[-+]", item)[0], UNKNOWN_DUTY), [item]))
    return stack[0]


class Scanner:
    def __init__(self):
        self.automaton = ahocorasick.Automaton()
        phrases = {p: [] for p in [*BASE, *NOTICES, TAG]}
        for p in phrases:
            self.automaton.add_word(f" {p} ", p)
        self.automaton.make_automaton()

    def scan(self, text: bytes) -> dict:
        words = split_words(text)
        body = f" {b' '.join(words).decode('utf-8', 'replace')} "
        base, notices, tags = [], set(), 0
        for end, phrase in self.automaton.iter(body):
            if phrase == TAG:
                tags += 1
                continue
            if phrase in BASE:
                base.append((end - len(phrase) - 1, BASE[phrase]))
            if phrase in NOTICES:
                notices.add(NOTICES[phrase])
        base.sort()
        base_labels = {label for _, label in base}
        duty, valid, named = None, 0, set()
        for found in TAG_LINE.findall(text.decode("utf-8", "replace")) if tags else ():
            order = postfix(found)
            result = evaluate(order) if order else None
            if result:
                valid += 1
                named.update(result[1])
                # Several tags in one text all hold.
                duty = result[0] if duty is None else max(duty, result[0])
        evidence = len(base) + len(notices)
        return {
            "n_words": len(words),
            "n_base": len(base),
            "first_word": body.count(" ", 0, base[0][0]) if base else None,
            "last_word": body.count(" ", 0, base[-1][0]) if base else None,
            "base_labels": ",".join(sorted(base_labels)),
            "labels": ",".join(sorted(base_labels | notices | named)),
            "score": 1.0 if valid else 0.0 if not evidence and not tags else 1.0 - 0.5 ** min(evidence + tags, 40),
            "duty": None if duty is None else DUTY_NAMES[duty],
        }


FIELDS = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()), T.StructField("first_word", T.LongType()),
    T.StructField("last_word", T.LongType()), T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()),
    T.StructField("score", T.DoubleType()), T.StructField("duty", T.StringType()),
])
_ARROW = pa.schema([
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("duty", pa.string()),
])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    for batch in batches:
        found = [scanner.scan(text or b"") for text in batch.column("text").to_pylist()]
        columns = [pa.array([f[c] for f in found], _ARROW.field(c).type) for c in _ARROW.names]
        yield pa.RecordBatch.from_arrays([batch.column("row"), *columns], names=["row", *_ARROW.names])


def scan_licenses(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Documents as `row` (struct of the carried columns) with the statements found in them.

    n_base, first_word, last_word and base_labels are about the base phrases: all places, the smallest and
    largest word at which one starts (null without any), their labels. `labels` adds the labels of closer
    notices and the identifiers of valid tag expressions. `score` is 0 without evidence, 1 with a valid
    expression, else 1 - 0.5 to the number of statements. `duty` is what the tag expressions ask for, null
    without a valid one. Null texts are empty; rows are scanned each for itself; an empty table gives no
    rows; other columns may have any name.
    """
    inner = docs.select(F.struct(*[F.col(c) for c in carry]).alias("row"), F.col(text).cast("binary").alias("text"))
    return inner.mapInArrow(_scan, T.StructType([inner.schema["row"], *FIELDS.fields]))
