"""Classification, numbers, times, hashes and ids."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab
from .text import mime, strip


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sniffed(content) -> Column:
    """``atom``, ``rss`` or null from the first 2 KiB."""
    head = F.lower(F.decode(F.substring(_c(content), 1, 2048), "utf-8"))
    return F.when(F.contains(head, F.lit("<feed")), "atom").when(
        F.contains(head, F.lit("<rss")) | F.contains(head, F.lit("<rdf:rdf")), "rss"
    )


def feed_type(override, content_type, content) -> Column:
    """What a source is: its own word, else its MIME type, else (for generic XML) its content, else html."""
    m = mime(content_type)
    return F.coalesce(
        _c(override),
        F.when(m.isin("application/rss+xml", "application/rdf+xml"), "rss").when(m == "application/atom+xml", "atom"),
        F.when(m.isin("text/xml", "application/xml"), sniffed(content)),
        F.lit("html"),
    )


def clamped(x) -> Column:
    """A score within 0 and 1; what isn't a number counts as 0 (NaN, the largest double, as 1)."""
    value = _c(x).try_cast("double")  # least and greatest would skip a null
    return F.when(value.isNull(), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))


def recency_bonus(published, start, end, most: float = 0.1) -> Column:
    """Linear from 0 at the window's start to ``most`` at its end; 0 without a time."""
    s, e = F.unix_micros(start), F.unix_micros(end)
    share = (F.unix_micros(_c(published)) - s) / F.greatest(e - s, F.lit(1_000_000))
    return F.when(share.isNull(), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)) * most)


def window_end(day) -> Column:
    """The last microsecond of a day."""
    return F.to_timestamp(day) + F.expr("interval 1 day") - F.expr("interval 1 microsecond")


def rank_of(level) -> Column:
    """0 for clear to 3 for red; null for anything else."""
    levels = F.array(*map(F.lit, vocab.TLP_LEVELS))
    return F.nullif(F.array_position(levels, _c(level)).cast("int"), F.lit(0)) - 1


def level_of(rank) -> Column:
    return F.get(F.array(*map(F.lit, vocab.TLP_LEVELS)), _c(rank))


def sha256(x) -> Column:
    return F.sha2(_c(x), 256)


def uuid5(namespace: uuid.UUID, key) -> Column:
    """The name-based UUID (version 5) of a string key; null for a null key."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(_c(key), "utf-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(F.lit(3)).bitwiseOR(F.lit(8))))
    dash = F.lit("-")
    return F.concat(
        F.substring(h, 1, 8), dash, F.substring(h, 9, 4), dash, F.lit("5"), F.substring(h, 14, 3), dash, variant, F.substring(h, 18, 3), dash, F.substring(h, 21, 12)
    )


def entity_key(kind, name, attack_id, cve) -> Column:
    """The natural key of an entity, null where its type has none."""
    k, lowered = _c(kind), F.lower(strip(name))
    named = k.isin("threat-actor", "intrusion-set", "malware", "tool") & (lowered != "")
    return (
        F.when(k == "attack-pattern", F.nullif(strip(attack_id), F.lit("")))
        .when(named, F.concat(k, F.lit("\0"), lowered))
        .when(k == "vulnerability", _c(cve))
    )


def entity_id(kind, name, attack_id, cve, fallback=None) -> Column:
    """``type--uuid``: name-based where there is a natural key, else ``fallback`` (a random UUID by default)."""
    key = entity_key(kind, name, attack_id, cve)
    return F.concat(_c(kind), F.lit("--"), F.coalesce(uuid5(vocab.NS_ENTITY, key), fallback if fallback is not None else F.uuid()))


def wire_time(ts) -> Column:
    """The wire form of a time: seconds, and milliseconds that are always 000."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss'.000Z'")


def seconds_between(start, end) -> Column:
    return (F.unix_micros(_c(end)) - F.unix_micros(_c(start))) / 1e6


def model_of(task, simple: str, medium: str, complex_: str) -> Column:
    """The model of a tier; medium for unknown tiers."""
    return F.when(_c(task) == "simple", simple).when(_c(task) == "complex", complex_).otherwise(medium)
