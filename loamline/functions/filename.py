"""What a log file's name and address tell."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loamline.functions.version import expand_key

#: Words of unreleased versions.
TRUNK = r"(?i)\b(?:git|svn|master|trunk)\b"
#: Fixed value: names of files that tell their server.
FORCED = r"^remote.(\w+)-[\w.-]+$"


def kind(name: Column) -> Column:
    return F.when(F.lower(name).contains("milestone"), F.lit("milestone")).otherwise(F.lit("logfile"))


def strict_kind(name: Column) -> Column:
    low = F.lower(name)
    return F.when(low.contains("logfile"), F.lit("logfile")).when(low.contains("milestone"), F.lit("milestone")).otherwise(F.lit("unknown"))


def game(name: Column, tags: list[tuple[str, list[str]]], default: str = "") -> Column:
    """By tag words, in the order of the table."""
    out = None
    for value, words in tags:
        hit = name.rlike(r"\b(?:" + "|".join(words) + r")\b")
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


#: A version with its dot, and one of two digits.
DOTTED, KEY = r"(\d+[.]\d+)", r"(\d{2})\b"


def version(name: Column) -> Column:
    return F.when(name.rlike(TRUNK), F.lit("git")).when(name.rlike(DOTTED), F.regexp_extract(name, DOTTED, 1)).when(name.rlike(KEY), expand_key(F.regexp_extract(name, KEY, 1))).otherwise(F.lit("any"))


def qualified_name(server: Column, kind_: Column, version_: Column, game_: Column, qualifier: Column) -> Column:
    """remote.<server>-<kind>-<version>, then game and qualifier where there are any."""
    empty = lambda c: F.nullif(c, F.lit(""))
    return F.concat(F.lit("remote."), F.concat_ws("-", server, kind_, version_, empty(game_), empty(qualifier)))


def url_join(base: Column, path: Column) -> Column:
    """One slash between; a path that is an address of its own stays."""
    return F.when(path.contains("://"), path).otherwise(F.concat(F.regexp_replace(base, r"/+\z", ""), F.lit("/"), F.regexp_replace(path, "^/+", "")))


def target_path(server: Column, url: Column) -> Column:
    """The address's path under the server's name."""
    path = F.when(url.contains("://"), F.regexp_extract(url, r"^[^:]*://[^/]*(/[^?#]*)?", 1)).otherwise(url)
    return F.regexp_replace(F.concat(server, F.lit("/"), path), "/+", "/")


def forced_server(name: Column) -> Column:
    """The server in remote.<server>-<rest>; empty for other names."""
    return F.regexp_extract(name, FORCED, 1)
