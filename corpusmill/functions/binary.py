"""Binary encoders for publishing: base 58, length-prefixed strings, and a post's wire form."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the base 58 alphabet.
ALPHABET = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"


def from_base58(text: str) -> bytes:
    """Leading ones are zero bytes; an empty text or only ones add one more, the number zero itself."""
    value = sum(ALPHABET.index(c) * 58**k for k, c in enumerate(reversed(text)))
    return bytes(len(text) - len(text.lstrip("1"))) + value.to_bytes(max(1, -(-value.bit_length() // 8)), "big")


def varuint(n: int) -> bytes:
    """Seven bits a byte, low bits first, the top bit set on all but the last."""
    sevens = [n >> s & 0x7F for s in range(0, max(n.bit_length(), 1), 7)]
    return bytes([x | 0x80 for x in sevens[:-1]] + sevens[-1:])


def prefixed(text: str) -> bytes:
    raw = text.encode()
    return varuint(len(raw)) + raw


def post(fields: list[str], operation: int = 1) -> bytes:
    """A post operation: its number, then its fields in wire order."""
    return varuint(operation) + b"".join(map(prefixed, fields))


def transaction(block_num: int, block_prefix: int, expires: int, posts: list[list[str]]) -> bytes:
    """References and expiry as little-endian numbers, the operations, and no extensions."""
    head = block_num.to_bytes(2, "little") + block_prefix.to_bytes(4, "little") + expires.to_bytes(4, "little")
    return head + varuint(len(posts)) + b"".join(map(post, posts)) + varuint(0)


@F.pandas_udf(T.BinaryType())
def post_encode(fields: pd.Series) -> pd.Series:
    return fields.map(lambda x: post(["" if f is None else f for f in x]), na_action="ignore")


@F.pandas_udf(T.BinaryType())
def base58_decode(text: pd.Series) -> pd.Series:
    return text.map(from_base58, na_action="ignore")


@F.pandas_udf(T.BinaryType())
def varuint_encode(n: pd.Series) -> pd.Series:
    return n.map(lambda x: varuint(int(x)), na_action="ignore")


@F.pandas_udf(T.BinaryType())
def string_encode(text: pd.Series) -> pd.Series:
    return text.map(prefixed, na_action="ignore")
