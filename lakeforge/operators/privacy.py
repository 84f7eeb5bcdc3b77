"""Policies for sensitive columns, applied in one projection: null, mask, keyed hash, encryption."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOW = ("null", "mask", "hash", "encrypt")


@dataclass
class Policy:
    """How a column is kept. ``shown`` characters at the end stay in a mask; hashes and ciphers name the key they were made with."""

    how: str
    shown: int = 4
    key_id: str | None = None

    def __post_init__(self):
        if self.how not in HOW:
            raise ValueError(f"unknown policy {self.how!r}; one of {HOW}")
        if self.how in ("hash", "encrypt") and not self.key_id:
            raise ValueError(f"the policy {self.how} needs a key_id")


def _key(keys: dict[str, bytes], key_id: str) -> Column:
    if key_id not in keys:
        raise ValueError(f"no key {key_id!r}")
    if len(keys[key_id]) not in (16, 24, 32):
        raise ValueError(f"key {key_id!r} has {len(keys[key_id])} bytes, not 16, 24 or 32")
    return F.unhex(F.lit(keys[key_id].hex()))


def masked(c: Column, shown: int) -> Column:
    """Stars for all but the last characters; of a text no longer than these all are stars."""
    n = F.length(c)
    return F.when(n <= shown, F.repeat(F.lit("*"), n)).otherwise(F.concat(F.repeat(F.lit("*"), n - shown), F.substring(c, -shown, shown) if shown else F.lit("")))


def protect(df: DataFrame, policies: dict[str, Policy], keys: dict[str, bytes] | None = None) -> DataFrame:
    """The frame with its sensitive columns protected; nulls stay null, a policy for a column it hasn't is an error.

    null keeps the type; the others make strings. A hash is SHA-256 over the key and the value, so
    equal values still join, but only under the same key. A cipher is ``<key id>:<base64>`` by
    AES-GCM with the column's name as authenticated data, so it can't be moved to another column.
    """
    if absent := set(policies) - set(df.columns):
        raise ValueError(f"policies for columns that aren't there: {sorted(absent)}")
    keys, out = keys or {}, {}
    for c, p in policies.items():
        value = F.col(f"`{c}`").cast("string")
        if p.how == "null":
            out[c] = F.lit(None).cast(df.schema[c].dataType)
        elif p.how == "mask":
            out[c] = masked(value, p.shown)
        elif p.how == "hash":
            out[c] = F.sha2(F.concat(_key(keys, p.key_id), value.cast("binary")), 256)
        else:
            coded = F.aes_encrypt(value.cast("binary"), _key(keys, p.key_id), F.lit("GCM"), F.lit("DEFAULT"), F.lit("").cast("binary"), F.lit(c).cast("binary"))
            out[c] = F.when(value.isNotNull(), F.concat(F.lit(f"{p.key_id}:"), F.base64(coded)))
    return df.withColumns(out)


def reveal(df: DataFrame, columns: dict[str, T.DataType | str], keys: dict[str, bytes]) -> DataFrame:
    """Encrypted columns as values of their types again; null where the key is unknown or wrong, or the cipher was changed."""
    out = {}
    for c, kind in columns.items():
        value = None
        named, coded = F.substring_index(f"`{c}`", ":", 1), F.try_to_binary(F.substring_index(f"`{c}`", ":", -1), F.lit("base64"))
        for key_id in keys:
            clear = F.try_aes_decrypt(coded, _key(keys, key_id), F.lit("GCM"), F.lit("DEFAULT"), F.lit(c).cast("binary")).cast("string")
            value = (F if value is None else value).when(named == key_id, clear)
        out[c] = F.lit(None).cast(kind) if value is None else value.try_cast(kind)
    return df.withColumns(out)


def encryption_enabled(config: dict, name: str = "data_privacy_mode") -> bool:
    """Whether a global configuration asks for encryption; masking to null stands in for it otherwise."""
    return any(i.get("config_name") == name and i.get("enable") is True for i in config.get("global_configuration", []))


def sensitive(df: DataFrame, columns: list[str], config: dict, key_id: str | None, keys: Callable[[str], bytes] | dict[str, bytes]) -> DataFrame:
    """A feed's sensitive columns encrypted or set to null, as the configuration says."""
    if not encryption_enabled(config):
        return protect(df, {c: Policy("null") for c in columns})
    found = {key_id: keys(key_id)} if callable(keys) else keys
    return protect(df, {c: Policy("encrypt", key_id=key_id) for c in columns}, found)
