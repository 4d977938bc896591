"""Text scalars as Column expressions; Arrow functions only for compression and Python value syntax."""

from __future__ import annotations

import json
import zlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What the markup filter removes, in this order.
MARKUP = ("---", "*", "<sup>", "</sup>", "\n", ">", "$", "^", "{", "}", "#")
# How links, boxes and fenced blocks are written.
IMAGE_LINK = r"\[Image\]\(.*?\)"
_NUMBER = r"([-+]?\d*\.\d+|\d+)"
#: Boxes written as [Image](a,b,c,d): floats with an optional sign, or unsigned integers.
IMAGE_BOX = r"\[Image\]\(" + r",\s*".join([_NUMBER] * 4) + r"\)"
#: Boxes written as [a, b, c, d]: floats only.
LIST_BOX = r"\[\s*" + r"\s*,\s*".join([r"(-?\d+\.\d+)"] * 4) + r"\s*\]"
FENCE = r"(?s)```(.*?)```"


def strip(s: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(s, r"(?U)^\s+|(?U)\s+$", "")


def plain_path(path: Column) -> Column:
    """A path as it is in its store, from one that the file source has escaped."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def strip_chars(s: Column, chars: str) -> Column:
    """Without any of the characters at both ends: a set of characters, not a suffix."""
    return F.btrim(s, F.lit(chars))


def strip_stop_token(s: Column, token: str) -> Column:
    """Without one trailing stop token: what strip_chars is often mistaken for."""
    return F.when(s.endswith(token), F.substring(s, F.lit(1), F.length(s) - len(token))).otherwise(s)


def without_markup(s: Column) -> Column:
    for piece in MARKUP:
        s = F.replace(s, F.lit(piece), F.lit(""))
    return F.regexp_replace(s, IMAGE_LINK, "")


def flat_html(html: Column) -> Column:
    """Lines stripped and joined with nothing; tags stay."""
    return F.array_join(F.transform(F.split(html, "\n", -1), strip), "")


def fenced_block(s: Column) -> Column:
    """The first fenced block, stripped, language tag included; a text without one is returned as it is."""
    return F.when(s.rlike(FENCE), strip(F.regexp_extract(s, FENCE, 1))).otherwise(s)


def boxes(s: Column, pattern: str = IMAGE_BOX) -> Column:
    """All boxes named in a text: an array of (x0, y0, x1, y1) doubles. The text is searched once; matches are split at commas."""
    whole = F.regexp_extract_all(s, F.lit(pattern), F.lit(0))
    numbers = F.transform(whole, lambda m: F.split(F.btrim(F.replace(m, F.lit("[Image]"), F.lit("")), F.lit("[]()")), ","))
    return F.transform(numbers, lambda n: F.struct(*[F.trim(F.translate(F.get(n, F.lit(i)), "\n\t\r\x0b\f", "     ")).cast("double").alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))]))


def without_prefix(path: Column, prefix: str) -> Column:
    """The path relative to a prefix; other paths are returned as they are."""
    full = prefix.rstrip("/") + "/"
    return F.when(path.startswith(full), F.substring(path, F.lit(len(full) + 1), F.length(path))).otherwise(path)


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def dirname(path: Column) -> Column:
    parts = F.split(path, "/")
    return F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), "/")


def last_parts(path: Column, n: int, joiner: str = "/") -> Column:
    parts = F.split(path, "/")
    return F.array_join(F.slice(parts, F.greatest(F.size(parts) - n + 1, F.lit(1)), F.lit(n)), joiner)


def ends_with_any(s: Column, suffixes: str | tuple[str, ...] | list[str]) -> Column:
    """Suffix test; no dot is implied, and 'any' or 'all' accept everything."""
    if suffixes in ("any", "all"):
        return F.lit(True)
    out = F.lit(False)
    for x in (suffixes,) if isinstance(suffixes, str) else suffixes:
        out = out | s.endswith(x)
    return out


def is_url(s: Column) -> Column:
    """Scheme and host are both non-empty."""
    return s.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+")


def image_tags(ids: Column) -> Column:
    return F.array_join(F.transform(ids, lambda i: F.concat(F.lit("<img>"), i, F.lit("</img>"))), "")


def image_placeholders(n: Column) -> Column:
    """<img_i></img_i> and a line end for each of n images."""
    one = lambda i: F.concat(F.lit("<img_"), i.cast("string"), F.lit("></img_"), i.cast("string"), F.lit(">\n"))
    return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n.cast("int") - 1), one), "")).otherwise("")


def data_uri(payload: Column, kind: str = "image/jpeg") -> Column:
    return F.concat(F.lit(f"data:{kind};base64,"), payload)


def base64_text(data: Column) -> Column:
    """Base64 without line breaks whatever the session says; null stays null."""
    return F.replace(F.base64(data), F.lit("\r\n"), F.lit(""))


def chat_turn(role: Column, text: Column) -> Column:
    """A turn between the chat markers that training reads."""
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>"))


def role_text(role: Column, text: Column) -> Column:
    return F.concat(role, F.lit(": "), text)


def prompt(template: str, *slots: Column) -> Column:
    """A template with %s slots."""
    return F.format_string(template, *slots)


def lfs_size(pointer: Column) -> Column:
    """Bytes that a pointer file names, or null."""
    return F.when(is_lfs_pointer(pointer), F.regexp_extract(pointer, r"size\s+(\d+)\s*$", 1).try_cast("bigint"))


def is_lfs_pointer(text: Column) -> Column:
    return F.contains(text, F.lit("version https://git-lfs.github.com/spec/v1"))


def resolve_url(repo: Column, path: Column) -> Column:
    """A file's address in a repository: /resolve/main is added where it is missing."""
    base = F.rtrim(repo, F.lit("/"))
    root = F.when(base.endswith("/resolve/main"), base).otherwise(F.concat(base, F.lit("/resolve/main")))
    return F.concat(root, F.lit("/"), path)


def saved_path(url: Column, root: str) -> Column:
    """Where a resolved address is saved: what comes before resolve/main/ gives way to a root."""
    return F.concat(F.lit(root.rstrip("/") + "/"), F.substring_index(url, "resolve/main/", -1))


def report_line(key: Column, value: Column, bold: bool = False) -> Column:
    return F.concat(F.lit("**"), key, F.lit("**: "), value, F.lit("\n")) if bold else F.concat(key, F.lit(": "), value, F.lit("\n"))


def tail_number(s: Column, unit: str = "it") -> Column:
    """The integer before a unit at the start of the last line, or null."""
    return F.regexp_extract(F.element_at(F.split(F.rtrim(s, F.lit("\n")), "\n"), -1), rf"^\s*(\d+)\s*{unit}", 1).try_cast("bigint")


def percent(s: Column) -> Column:
    return F.substring(s, F.lit(1), F.length(s) - 1).try_cast("double")


def unique_name(name: Column, *content: Column) -> Column:
    """A name made unique by what it names: the same for the same content, in any run."""
    return F.concat(name, F.lit("#"), F.sha2(F.concat_ws("|", *content), 256))


def content_key(data: Column) -> Column:
    return F.sha2(data, 256)


def seconds(s: Column) -> Column:
    """%H:%M:%S.%f as seconds; the fraction (1 to 6 digits) is needed. Anything else is null."""
    pattern = r"^([01]?\d|2[0-3]):([0-5]?\d):([0-5]?\d)\.(\d{1,6})$"
    h, m, sec, f = (F.regexp_extract(s, pattern, k) for k in (1, 2, 3, 4))
    value = h.try_cast("int") * 3600 + m.try_cast("int") * 60 + sec.try_cast("int") + F.rpad(f, 6, "0").try_cast("int") / F.lit(1e6)
    return F.when(s.rlike(pattern), value)


def frame_at(second: Column, fps: Column, n: Column) -> Column:
    """The frame of a second, within 0 and n."""
    return F.least(F.greatest((second * fps).cast("int"), F.lit(0)), n)


def experiment(index: Column) -> Column:
    """What an index file stands for: its folder's name and its own name's first piece."""
    parts = F.split(index, "/")
    return F.concat(F.get(parts, F.size(parts) - 2), F.get(F.split(F.get(parts, F.size(parts) - 1), "_"), F.lit(0)))


def patched(settings: Column, put: dict[str, str], drop: tuple[str, ...] = ()) -> Column:
    """A map of settings with some set anew and some taken out."""
    kept = F.map_filter(settings, lambda k, v: ~k.isin(*put, *drop)) if put or drop else settings
    return F.map_concat(kept, F.create_map(*[F.lit(x) for kv in put.items() for x in kv])) if put else kept


@F.pandas_udf(T.BooleanType())
def is_repetitive(texts: pd.Series) -> pd.Series:
    """Compresses more than fourfold, or has a full window of 1000 characters that compresses more than 3.5-fold."""

    def ratio(s: str) -> float:
        raw = s.encode("utf-8", "surrogatepass")
        return len(raw) / len(zlib.compress(raw))

    def judge(s: str | None) -> bool:
        if not s:
            return False
        return ratio(s) > 4 or any(ratio(s[i : i + 1000]) > 3.5 for i in range(0, len(s) - 999, 1000))

    return texts.map(judge).astype(bool)


@F.pandas_udf(T.StringType())
def values_as_text(objects: pd.Series) -> pd.Series:
    """A JSON object with its top-level values as Python prints them (True, None, {'e': 1}); what isn't an object is null."""

    def one(s: str | None) -> str | None:
        try:
            got = json.loads(s)
        except (TypeError, ValueError):
            return None
        return json.dumps({k: str(v) for k, v in got.items()}) if isinstance(got, dict) else None

    return objects.map(one)


def values_as_strings(obj: Column) -> Column:
    """Top-level values as text, JSON syntax for what isn't a string or number: no Python."""
    return F.from_json(obj, "map<string,string>")
