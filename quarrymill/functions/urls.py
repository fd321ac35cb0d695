"""URL and path expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..settings import BLOCKED_URL_PARTS, IMAGE_EXTENSIONS, PICTURE_URL, THUMBNAIL_URL, URL_ESCAPES


def unescape(url: Column) -> Column:
    for escape, plain in URL_ESCAPES:
        url = F.replace(url, F.lit(escape), F.lit(plain))
    return url


def letters_digits(name: Column) -> Column:
    """Letters and digits of a name, ignoring letter case; null stays null."""
    return F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]", "")


def is_blocked(url: Column) -> Column:
    return F.lower(url).rlike("|".join(BLOCKED_URL_PARTS))


def is_thumbnail(url: Column) -> Column:
    return url.rlike(THUMBNAIL_URL)


def wanted(url: Column) -> Column:
    return ~is_blocked(url) & ~is_thumbnail(url)


def picture_urls(html: Column, pattern: str = PICTURE_URL) -> Column:
    """Wanted picture URLs of a page in order of first appearance, unescaped, each once."""
    raw = F.regexp_extract_all(html, F.lit(pattern), F.lit(1))
    return F.array_distinct(F.filter(F.transform(raw, unescape), wanted))


def query_text(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit("+"))


def spoken_name(key: Column) -> Column:
    return F.initcap(F.translate(key, "_", " "))


def has_picture_extension(path: Column) -> Column:
    return F.lower(path).rlike("(" + "|".join(e.replace(".", r"\.") for e in IMAGE_EXTENSIONS) + ")$")


def parts(path: Column) -> Column:
    return F.split(path, r"[/\\]")


def label_of(path: Column) -> Column:
    """Name of the folder that holds the file; null for a bare file name."""
    return F.when(F.size(parts(path)) > 1, F.element_at(parts(path), -2))


def file_name(path: Column) -> Column:
    return F.element_at(parts(path), -1)


def numbered(label: Column, number: Column, extension: str = "jpg") -> Column:
    return F.format_string(f"%s_%04d.{extension}", label, number)


def number_of(name: Column) -> Column:
    """The number before the extension of a numbered name; null for other names."""
    return F.regexp_extract(name, r"_([0-9]{1,9})[.]jpg$", 1).try_cast("int")
