"""Column functions for the parsing rules of every layer.

All of them are built-in Spark expressions (JVM-side, inside whole-stage
codegen); none is a Python UDF. Each takes and returns ``Column`` so it works
the same in a batch or a streaming plan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from accesslake.schemas import RAW_FIELDS

# ---------------------------------------------------------------------------
# Fixed values that must stay as they are for results to match the reference.
# ---------------------------------------------------------------------------
# Raw log lines are tab-separated; IP library lines are pipe-separated.
FIELD_SEP = "\t"
IP_SEP = "|"
# Field positions read from one IP library line: ip, province, city, isp.
IP_FIELD_POS = {"ip": 0, "province": 6, "city": 7, "isp": 9}
# Field positions of city and host in a V1 tab-separated DWD line.
TSV_CITY_POS = 11
TSV_HOST_POS = 14
# Marks a value that could not be parsed or looked up.
MISSING = "-"
# responseSize that failed to parse; rows with it are dropped in ODS.
DIRTY_SIZE = -1
# Default for responseTime / requestSize that fail to parse.
NUMBER_DEFAULT = 0
# How a NULL prints when a row is rendered as a text line.
NULL_TEXT = "null"
# Reject reasons.
REASON_SHORT = "short"
REASON_DIRTY = "dirty_size"

# A whole-string signed decimal integer, as Java's Long.parseLong accepts it.
# `\z` (end of input) and not `$`: Java's `$` also matches before a final line
# terminator. Overflow is caught by try_cast (NULL).
_LONG_TEXT = r"^[+-]?[0-9]+\z"

# Log time text: `[yyyy/MM/dd ...`, `[yyyy/MM/dd/:...` or `[dd/MM/yyyy:...`.
# The leading `.` is the bracket. Digits are taken as text: going through a
# timestamp would move rows before 08:00 +0800 to the previous UTC day.
_YMD = r"^.[0-9]{4}/[0-9]{2}/[0-9]{2}"
_DMY = r"^.[0-9]{2}/[0-9]{2}/[0-9]{4}"

# URL parts as java.net.URL reports them, each read by a short anchored
# pattern: the scheme; the authority (after `//`, up to `/`, `?` or `#`);
# host:port within the authority (after a single user-info `@`; two or more
# `@` give no match, so an empty host and no port, as java.net.URL reads it);
# the path (after the authority, up to `?` or `#`); the query (after the
# first `?`, up to `#`).
# `mailto:` and `jar:` URLs have no authority: all up to `#` is path and, after
# its last `?`, query.
URL_OPAQUE = "(?i:mailto|jar):"
URL_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"
URL_AUTHORITY = rf"^(?!{URL_OPAQUE})[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
URL_HOSTPORT = r"^(?:[^@]*@)?([^@]*)$"
URL_PATH = (
    rf"^(?:(?!{URL_OPAQUE})[A-Za-z][A-Za-z0-9+.-]*:(?://[^/?#]*)?|{URL_OPAQUE})"
    rf"((?<=^{URL_OPAQUE})[^#]*?(?=(?:[?][^?#]*)?(?:#|\z))|(?<!^{URL_OPAQUE})[^?#]*)"
)
URL_QUERY = rf"^(?:{URL_OPAQUE}[^#]*|(?!{URL_OPAQUE})[^?#]*)[?]([^#]*)"
# java.net.URL accepts a URL only when it has a handler for the scheme (these
# are the handlers of Java 8) and the port is empty or a signed int of at
# least -1, as Integer.parseInt reads it (a second `:` in host:port makes the
# port unreadable). Anything else is malformed.
URL_PROTOCOLS = ["http", "https", "ftp", "file", "jar", "mailto", "netdoc"]
# `scheme:////...` is a UNC name to java.net.URL: no authority is read and the
# path keeps all four slashes.
URL_UNC_SLASHES = ":////"
URL_UNC = rf"^(?!{URL_OPAQUE})[A-Za-z][A-Za-z0-9+.-]*:////"
# java.net.URL drops characters up to the space at both ends, then one leading
# `url:` in any case.
URL_TRIM = "".join(map(chr, range(0x21)))
URL_PREFIX = "url:"
# A host in brackets is an IPv6 address: eight groups, or fewer around one `::`.
# A zone id may follow after `%`; an IPv4 address may stand for the last two groups.
URL_BRACKETS = r"^(\[[^\]]*\])(.*)$"
_HEX, _OCTET = "[0-9A-Fa-f]+", "(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
_GROUP, _IPV4 = "0*[0-9A-Fa-f]{1,4}", rf"{_OCTET}(?:\.{_OCTET}){{3}}"
IPV6 = (
    rf"^\[(?:(?:{_GROUP}:){{7}}{_GROUP}|(?:{_GROUP}:){{6}}{_IPV4}"
    rf"|(?!:*{_HEX}(?::+{_HEX}){{7}})(?:{_GROUP}(?::{_GROUP})*)?::(?:{_GROUP}(?::{_GROUP})*)?"
    rf"|(?!:*{_HEX}(?::+{_HEX}){{5}}:)(?:{_GROUP}(?::{_GROUP})*)?::(?:{_GROUP}:)*{_IPV4})(?:%[^\]]+)?\]$"
)
# A `mailto:` URL names something that is not white space.
MAILTO_TEXT = r"[^#\x09-\x0D\x1C-\x20]"
MAILTO = rf"^[A-Za-z]+:[^#]*?{MAILTO_TEXT}"
# A `jar:` URL names an entry after its last `!/`; before that stands a URL that
# must be well-formed (one whose handler reads an authority, or a `mailto:`).
JAR_INNER = r"^[A-Za-z]+:([^#]*)!/"
# A port of at most 2147483647.
JAR_PORT = (
    "(:([+]?0*([0-9]{1,9}|1[0-9]{9}|20[0-9]{8}|21[0-3][0-9]{7}|214[0-6][0-9]{6}|2147[0-3][0-9]{5}|21474[0-7][0-9]{4}"
    "|214748[0-2][0-9]{3}|2147483[0-5][0-9]{2}|21474836[0-3][0-9]|214748364[0-7])|-0*[01])?)?"
)
JAR_USER = r"([^@/?]*@)?"
JAR_AUTHORITY = rf"([^@/?]*@[^@/?]*@[^/?]*|{JAR_USER}([^:@/?\[][^:@/?]*)?{JAR_PORT}|{JAR_USER}\[[0-9A-Fa-f.]*:[0-9A-Fa-f.:]*(%[^\]/?]+)?\]{JAR_PORT})"
JAR_URL = (
    rf"^[\x00-\x20]*([uU][rR][lL]:)?([mM][aA][iI][lL][tT][oO]:.*{MAILTO_TEXT}"
    r"|([hH][tT][tT][pP][sS]?|[fF][tT][pP]|[fF][iI][lL][eE]|[nN][eE][tT][dD][oO][cC]):"
    rf"(/?$|/?[^/]|//{JAR_AUTHORITY}([/?]|$)))"
)
# ---------------------------------------------------------------------------


def split_fields(value: Column, sep: str = FIELD_SEP) -> Column:
    """Split on a literal separator and keep trailing empty fields."""
    pattern = "\\" + sep if sep in "|.^$*+?()[]{}\\" else sep
    return F.split(value, pattern, -1)


def field(fields: Column, pos: int) -> Column:
    """0-based field of a split array; NULL when the line is too short."""
    return F.get(fields, pos)


def raw_field_columns(fields: Column) -> list[Column]:
    """The 11 positional raw fields as named string columns."""
    return [field(fields, i).alias(name) for i, name in enumerate(RAW_FIELDS)]


def parse_long(text: Column) -> Column:
    """Long.parseLong semantics: optional sign and digits only, else NULL.

    try_cast alone is too lenient (it trims spaces) and a plain cast fails the
    job under ANSI mode, hence the guard.
    """
    return F.when(text.rlike(_LONG_TEXT), text.try_cast("bigint"))


def long_or(text: Column, default: int) -> Column:
    """parse_long with a default for text that is not a whole number (or NULL)."""
    return F.coalesce(parse_long(text), F.lit(default).cast("bigint"))


def time_parts(time: Column) -> tuple[Column, Column, Column]:
    """(year, month, day) as zero-padded strings; '-' for all three if unknown.

    Both layouts have fixed widths after the bracket, so once one matches the
    parts are plain substrings (1-based: yyyy/MM/dd at 2, 7, 10; dd/MM/yyyy at
    8, 5, 2).
    """
    ymd = time.rlike(_YMD)
    dmy = time.rlike(_DMY)

    def part(ymd_pos: int, dmy_pos: int, width: int) -> Column:
        return (
            F.when(ymd, F.substring(time, ymd_pos, width))
            .when(dmy, F.substring(time, dmy_pos, width))
            .otherwise(F.lit(MISSING))
        )

    return part(2, 8, 4), part(7, 5, 2), part(10, 2, 2)


def url_parts(url: Column) -> tuple[Column, Column, Column, Column]:
    """(protocol, host, path, params) with java.net.URL meaning.

    A malformed URL gives '-' for all four: no scheme (or NULL / empty), a
    scheme java.net.URL has no handler for, a port it cannot read, a bracketed
    host that is no IPv6 address, a `mailto:` of nothing, or a `jar:` without an
    entry or a well-formed URL before it. The protocol is
    lower-cased; a missing path is ''; a missing or empty query is '-'.
    """
    trimmed = F.btrim(url, F.lit(URL_TRIM))
    u = F.when(F.lower(F.left(trimmed, F.lit(len(URL_PREFIX)))) == URL_PREFIX, F.substr(trimmed, F.lit(len(URL_PREFIX) + 1), F.length(trimmed))).otherwise(trimmed)
    scheme = F.regexp_extract(u, URL_SCHEME, 1)
    hostport = F.regexp_extract(F.regexp_extract(u, URL_AUTHORITY, 1), URL_HOSTPORT, 1)
    bracketed = hostport.startswith("[")
    ipv6 = F.regexp_extract(hostport, URL_BRACKETS, 1)
    after = F.regexp_extract(hostport, URL_BRACKETS, 2)
    ipv6_ok = ipv6.rlike(IPV6) & ((after == "") | after.startswith(":"))
    colon = F.instr(hostport, ":")
    host = F.when(bracketed, ipv6).when(colon > 0, F.substr(hostport, F.lit(1), colon - 1)).otherwise(hostport)
    port = (
        F.when(bracketed, F.substr(after, F.lit(2), F.length(after)))
        .when(colon > 0, F.substr(hostport, colon + 1, F.length(hostport)))
        .otherwise(F.lit(""))
    )
    port_ok = (port == F.lit("")) | (
        port.rlike(_LONG_TEXT) & (F.coalesce(port.try_cast("int"), F.lit(-2)) >= F.lit(-1))
    )
    protocol = F.lower(scheme)
    opaque_ok = (
        F.when(protocol == "jar", F.regexp_extract(u, JAR_INNER, 1).rlike(JAR_URL)).when(protocol == "mailto", u.rlike(MAILTO)).otherwise(True)
    )
    valid = F.coalesce(protocol.isin(URL_PROTOCOLS) & port_ok & (~bracketed | ipv6_ok) & opaque_ok, F.lit(False))
    path = F.regexp_extract(u, URL_PATH, 1)
    query = F.regexp_extract(u, URL_QUERY, 1)
    missing = F.lit(MISSING)
    return (
        F.when(valid, protocol).otherwise(missing),
        F.when(valid, host).otherwise(missing),
        F.when(valid & F.contains(u, F.lit(URL_UNC_SLASHES)) & u.rlike(URL_UNC), F.concat(F.lit("//"), path)).when(valid, path).otherwise(missing),
        F.when(valid & (query != F.lit("")), query).otherwise(missing),
    )


def text_line(*cols: Column | str, sep: str = FIELD_SEP) -> Column:
    """Render columns as one separated line; NULL prints as 'null'.

    concat_ws alone would skip NULLs and shift every later field.
    """
    return F.concat_ws(
        sep,
        *[F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"),
                     F.lit(NULL_TEXT)) for c in cols],
    )


def day_from_path(path: Column) -> Column:
    """`YYYYMMDD` from a path ending in `d=YYYYMMDD` (optional trailing slash)."""
    return F.regexp_extract(path, r"(?:^|/)d=([^/]+)/?$", 1)


def day_of_file(path: Column) -> Column:
    """`YYYYMMDD` from the path of a file in a day folder; '' outside of one."""
    return F.regexp_extract(path, r"/d=([^/]+)/[^/]+$", 1)
