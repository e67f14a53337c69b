"""Column helpers for text, names, hashes and dates. Null in, null out unless said otherwise."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Default seed of stable orders; every function that uses it takes another one.
SEED = "wordtide-1"
_TRIM = r"^[\s 　]+|[\s 　]+$"


#: Letters whose folded form is not their small letter. Fixed values, with what they become.
FOLDED = (("ß", "ss"), ("ſ", "s"), ("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "st"), ("ﬆ", "st"))


def folded(c: Column) -> Column:
    """Case folded, as far as the result may be ASCII."""
    c = F.lower(c)
    for letter, plain in FOLDED:
        c = F.replace(c, F.lit(letter), F.lit(plain))
    return c


def canonical(c: Column) -> Column:
    """Unicode white space to single spaces, stripped, case folded (with ß as ss)."""
    return F.replace(F.lower(F.trim(F.regexp_replace(c, r"(?U)\s+", " "))), F.lit("ß"), F.lit("ss"))


def keyword_key(c: Column) -> Column:
    """Stripped and case folded; inner white space stays."""
    return F.replace(F.lower(F.regexp_replace(c, "(?U)" + _TRIM, "")), F.lit("ß"), F.lit("ss"))


def clean_text(c: Column, limit: int) -> Column:
    return F.left(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")), F.lit(limit))


def first_label(domain: Column) -> Column:
    return F.substring_index(domain, ".", 1)


def top_label(domain: Column) -> Column:
    return F.substring_index(domain, ".", -1)


def stable_hash(key: Column, seed: str = SEED) -> Column:
    """Lower-case hex SHA-256 of seed, NUL and key: an order that is the same everywhere."""
    return F.sha2(F.concat(F.lit(seed), F.lit("\0"), key), 256)


def strings(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def contained(c: Column, terms: Sequence[str]) -> Column:
    """Terms that occur in the text, in the order of the list."""
    return F.filter(strings(terms), lambda t: F.contains(c, t))


def full_match(c: Column, pattern: str) -> Column:
    """Whether the whole text matches, without regard to case."""
    return c.rlike(f"(?isU)^(?:{pattern})$")


def found_in(c: Column, pattern: str) -> Column:
    return c.rlike(f"(?iU)(?:{pattern})")


def listed(*pairs: tuple[Column, str]) -> Column:
    """Names whose conditions hold, in order."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for cond, name in pairs]))


LABEL = r"[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?"
_DIGITS = "abcdefghijklmnopqrstuvwxyz0123456789"
#: Fixed values of Bootstring for names: base, least and greatest threshold, skew, damp, first bias, first code point.
_BASE, _T_MIN, _T_MAX, _SKEW, _DAMP, _BIAS, _FIRST = 36, 1, 26, 38, 700, 72, 128
_LONG = "bigint"


def _whole(c) -> Column:
    return (c if isinstance(c, Column) else F.lit(c)).cast(_LONG)


def _state(**parts) -> Column:
    return F.struct(*[(v if k == "out" else _whole(v)).alias(k) for k, v in parts.items()])


def _steps(n: int) -> Column:
    return F.sequence(F.lit(1), F.lit(n))


def _adapted(delta: Column, points: Column, first: Column) -> Column:
    """The bias after a code point has been written."""
    d = F.when(first, F.floor(delta / _DAMP)).otherwise(F.floor(delta / 2))
    d = d + F.floor(d / points)
    limit = (_BASE - _T_MIN) * _T_MAX // 2
    shrink = lambda s, _: F.when(s["d"] > limit, _state(d=F.floor(s["d"] / (_BASE - _T_MIN)), k=s["k"] + _BASE)).otherwise(s)
    return F.aggregate(_steps(6), _state(d=d, k=0), shrink, lambda s: _whole(s["k"] + F.floor((_BASE - _T_MIN + 1) * s["d"] / (s["d"] + _SKEW))))


def _variable_length(delta: Column, bias: Column) -> Column:
    """A whole number as digits of falling thresholds."""
    digit = lambda x: F.substring(F.lit(_DIGITS), (x + 1).cast("int"), F.lit(1))

    def step(s: Column, _: Column) -> Column:
        t = F.least(F.greatest(s["k"] - s["bias"], F.lit(_T_MIN)), F.lit(_T_MAX))
        more = _state(q=F.floor((s["q"] - t) / (_BASE - t)), k=s["k"] + _BASE, bias=s["bias"], open=1, out=F.concat(s["out"], digit(t + (s["q"] - t) % (_BASE - t))))
        last = _state(q=0, k=s["k"], bias=s["bias"], open=0, out=F.concat(s["out"], digit(s["q"])))
        return F.when(s["open"] == 0, s).when(s["q"] < t, last).otherwise(more)

    return F.aggregate(_steps(9), _state(q=delta, k=_BASE, bias=bias, open=1, out=F.lit("")), step, lambda s: s["out"])


def once(value: Column, f) -> Column:
    """``f`` of a value that it uses several times, worked out once: a list of one, transformed."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def punycode(label: Column) -> Column:
    """A label's letters in ASCII (Bootstring), without a prefix. All of it are folds over the label's code points in the row."""
    points = F.transform(F.sequence(F.lit(1), F.length(label)), lambda i: F.ascii(F.substring(label, i, F.lit(1))).cast(_LONG))

    def encoded(x: Column) -> Column:
        plain = F.filter(x["points"], lambda c: c < _FIRST)
        head = F.array_join(F.transform(plain, lambda c: F.char(c)), "")
        start = _state(n=_FIRST, delta=0, bias=_BIAS, done=F.size(plain), plain=F.size(plain), out=F.when(F.size(plain) > 0, F.concat(head, F.lit("-"))).otherwise(F.lit("")))

        def place(t: Column, c: Column, n: Column) -> Column:
            first = t["done"] == t["plain"]
            written = _state(
                n=t["n"], delta=0, bias=_adapted(t["delta"], t["done"] + 1, first), done=t["done"] + 1, plain=t["plain"],
                out=F.concat(t["out"], _variable_length(t["delta"], t["bias"])),
            )
            passed = _state(n=t["n"], delta=t["delta"] + 1, bias=t["bias"], done=t["done"], plain=t["plain"], out=t["out"])
            return F.when(c < n, passed).when(c == n, written).otherwise(t)

        def level(s: Column, n: Column) -> Column:
            at = _state(n=n, delta=s["delta"] + (n - s["n"]) * (s["done"] + 1), bias=s["bias"], done=s["done"], plain=s["plain"], out=s["out"])
            after = lambda t: _state(n=t["n"] + 1, delta=t["delta"] + 1, bias=t["bias"], done=t["done"], plain=t["plain"], out=t["out"])
            return F.aggregate(x["points"], at, lambda t, c: place(t, c, n), after)

        return F.aggregate(F.array_sort(F.array_distinct(F.filter(x["points"], lambda c: c >= _FIRST))), start, level, lambda s: s["out"])

    return once(F.struct(points.alias("points")), encoded)


def ascii_name(name: Column) -> Column:
    """The ASCII form of a lower-case name; null if it has none: a label that is empty (the last may be) or has 64 letters or more,
    or letters that names may not hold.

    Wide forms of ASCII letters and ideographic dots become the plain ones, soft hyphens go, ß is ss and final ς is σ, as names of
    2003 have it. Letters are taken as composed; other compatibility letters stay as they are.
    """
    wide, plain = "".join(chr(c) for c in range(0xFF01, 0xFF5F)), "".join(chr(c) for c in range(0x21, 0x7F))
    mapped = folded(F.translate(F.regexp_replace(name, "[。．｡]", "."), wide + "ς\u00ad", plain + "σ"))
    odd = r"[^\x00-\x7F]"
    label = lambda x: F.when(~x.rlike(odd), x).when(~x.startswith("xn--") & ~x.rlike(r"[\p{C}\p{Z}]"), F.concat(F.lit("xn--"), punycode(x)))
    every = once(F.transform(F.split(mapped, r"\."), label), lambda c: F.when(F.forall(c, lambda x: x.isNotNull()), F.array_join(c, ".")))
    fits = lambda n: F.when(~n.rlike(r"(?:^|\.)\.") & ~n.rlike(r"[^.]{64}"), n)
    return once(F.when(name.rlike(odd), every).otherwise(name), fits)


def _bare(raw: Column, strict: bool) -> Column:
    value = F.lower(F.regexp_replace(raw, "(?U)" + _TRIM, ""))
    return F.regexp_replace(value, r"\.$" if strict else r"\.+$", "")


def _judged(raw: Column, strict: bool) -> Column:
    """struct(domain, reason) of a raw line."""
    space = r"(?U)\s" if strict else r"[\x00-\x20]"

    def named(x: Column) -> Column:
        bare, name = x["bare"], x["name"]
        reason = (
            F.when(bare.isNull() | ((bare == "") & ~x["dots"]), "blank_line")
            .when(bare.rlike(space), "embedded_whitespace")
            .when(bare.rlike(r"[/:@?#\\]"), "not_a_bare_domain")
            .when(name.isNull(), "idna_encoding_failed")
            .when(F.length(name) > 253, "hostname_too_long")
            .when(~name.contains("."), "missing_dot")
            .when(~name.rlike(rf"^{LABEL}(?:\.{LABEL})*$"), "invalid_dns_label")
            .when(F.lit(strict) & ~F.substring_index(name, ".", -1).rlike("[a-z]"), "numeric_top_level_label")
            .when(name.rlike(r"^(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?:\.(?!$)|$)){4}$"), "ip_address")
        )
        return F.struct(name.alias("name"), reason.alias("reason"))

    seen = lambda bare: F.struct(bare.alias("bare"), ascii_name(bare).alias("name"), raw.rlike(r"\.\s*$").alias("dots"))
    judged = once(once(_bare(raw, strict), seen), named)
    return once(judged, lambda j: F.struct(F.when(j["reason"].isNull(), j["name"]).alias("domain"), j["reason"].alias("reason")))


def domain_error(raw: Column, strict: bool = True) -> Column:
    """Reason for which a raw line is no domain, null for a valid one. The first fitting reason wins.

    C1 is the strict form: one dot at the end is allowed, the last label needs a letter. C2, the other form, strips all dots at the
    end, refuses control characters and addresses, and asks for no letter."""
    return _judged(raw, strict)["reason"]


def domain_of(raw: Column, strict: bool = True) -> Column:
    """The normalized domain of a raw line, in ASCII; null where ``domain_error`` has a reason."""
    return _judged(raw, strict)["domain"]


def _fold_batch(c: pd.Series) -> pd.Series:
    return c.map(lambda v: None if v is None else v.strip().casefold())


def casefolded(c: Column) -> Column:
    """Exact case folding, for texts where ``lower`` is not enough."""
    return F.pandas_udf(_fold_batch, "string")(c)


def source_date(path: Column) -> Column:
    """The date in a file's name; null if there is none or it is no date of the calendar."""
    return F.try_to_date(F.nullif(F.regexp_extract(path, r"(\d{4}-\d{2}-\d{2})", 1), F.lit("")))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def retry_at(value: Column, now: Column) -> Column:
    """When a request may be repeated, by a Retry-After value: seconds from now (a century at most) or an HTTP date,
    which without a zone is UTC. Never before now; what cannot be read means now."""
    seconds = F.least(F.greatest(F.trim(value).try_cast("bigint"), F.lit(0)), F.lit(3_155_760_000))
    parts = r"(?i)^\s*(?:[a-z]+,?\s+)?(\d{1,2})[ -]([a-z]{3})[a-z]*[ -](\d{4})\s+(\d{2}:\d{2}:\d{2})\s*(?:gmt|utc|ut|z)?\s*([+-]\d{4})?\s*$"
    group = lambda i: F.regexp_extract(value, parts, i)
    zone = F.when(group(5) == "", "+0000").otherwise(group(5))
    said = F.concat_ws(" ", group(1), F.initcap(group(2)), group(3), group(4), zone)
    date = F.when(value.rlike(parts), F.try_to_timestamp(said, F.lit("d MMM yyyy HH:mm:ss xx")))
    return F.greatest(now, F.timestamp_add("SECOND", seconds, now), date)


def content_type_base(c: Column) -> Column:
    return F.lower(F.trim(F.substring_index(c, ";", 1)))


def error_kind(code: Column) -> Column:
    """Kind of a transport error by exit code."""
    names = {6: "dns", 7: "connect", 28: "timeout", 35: "tls_handshake", 60: "certificate", 77: "local_ca"}
    out = F.lit("transport")
    for k, v in names.items():
        out = F.when(code == k, v).otherwise(out)
    return F.when(code.isNotNull() & (code != 0), out)


def header_value(raw: Column, name: str) -> Column:
    """A header of the last block of a response head."""
    block = F.substring_index(raw, "HTTP/", -1)
    return F.nullif(F.trim(F.regexp_extract(block, rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)), F.lit(""))


def guarded_cell(c: Column) -> Column:
    """A cell that spreadsheets do not take for a formula."""
    return F.when(c.rlike(r"^[ ]*[=+@\t\r\n-]"), F.concat(F.lit("'"), c)).otherwise(c)


def escaped_html(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def script_safe(c: Column) -> Column:
    """JSON that can stand inside a script element."""
    for a, b in (("</", "<\\/"), (" ", "\\u2028"), (" ", "\\u2029")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def scrubbed(c: Column) -> Column:
    """Tokens and socket addresses taken out."""
    return F.regexp_replace(F.regexp_replace(c, r"(?i)(token=)[^&\s]+", "$1***"), r"wss?://[^\s]+", "wss://***")


def page_fingerprint(title: Column, description: Column, headings: Column) -> Column:
    """SHA-256 of a canonical form of a page's fields; only equality matters."""
    form = F.concat_ws("\x1f", F.coalesce(title, F.lit("")), F.coalesce(description, F.lit("")), F.array_join(headings, "\x1e"))
    return F.sha2(form, 256)
