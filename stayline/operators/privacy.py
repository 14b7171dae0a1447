"""Vaulting, masking, leak scan and erasure."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.functions import masks
from stayline.schemas import TABLES

SAFE_TABLES = ["sales", "service", "insurance", "churn_features", "churn_scores"]
LEAST_NAME_LENGTH = 4
#: First bytes of a name that are looked at before its whole hash, at most LEAST_NAME_LENGTH, and bits of their set.
HEAD, HEAD_BITS = 4, 16
#: The most bits of the set of names' hashes (16 MB).
MOST_BITS = 27
#: Base of the texts' polynomial hash and its inverse modulo 2^64.
BASE = 0x5851F42D4C957F2D
BACK = pow(BASE, -1, 1 << 64)


def vault(raw: DataFrame) -> DataFrame:
    """The access-controlled part of a registration."""
    return raw.select(*TABLES["pii_vault"].fieldNames())


def masked(raw: DataFrame, keep: tuple[str, ...] = ("preferred_dealer_id", "created_at", "updated_at")) -> DataFrame:
    """The analytical part of the same rows: masks and coarse attributes only."""
    return raw.select(
        "cust_id",
        masks.mask_name(F.col("cust_name")).alias("name_masked"),
        masks.mask_mobile(F.col("mobile_1")).alias("mobile_masked"),
        masks.mask_email(F.col("email")).alias("email_masked"),
        masks.birth_year(F.col("dob")).alias("birth_year"),
        "gender",
        "occ_id",
        "city",
        "state",
        "pincode",
        *[c for c in keep if c in raw.columns],
    )


def split(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    return vault(raw), masked(raw)


def reveal(customers: DataFrame, pii: DataFrame, show_pii: bool = False) -> DataFrame:
    """Customers with their raw fields, joined by token, only on explicit request."""
    if not show_pii:
        return customers
    personal = pii.select("cust_id", "cust_name", "mobile_1", "mobile_2", "email", "dob", "address")
    return customers.join(personal, "cust_id", "left")


def erase(pii: DataFrame, requests: DataFrame) -> DataFrame:
    """The vault without the requested tokens. Every other table keeps its token and loses its meaning."""
    return pii.join(requests.select("cust_id").distinct(), "cust_id", "left_anti")


def _spread(value: np.ndarray) -> np.ndarray:
    return value * np.uint64(0x9E3779B97F4A7C15)


class Bytes:
    """All texts of an array as one run of bytes, with the hash of any part of it (a polynomial modulo 2^64)."""

    def __init__(self, texts: pa.Array):
        held = texts.cast(pa.large_binary())
        self.at = np.frombuffer(held.buffers()[1], np.int64)[held.offset : held.offset + len(held) + 1]
        raw = np.frombuffer(held.buffers()[2], np.uint8) if self.at[-1] else np.empty(0, np.uint8)
        self.raw, self.at = raw[self.at[0] : self.at[-1]], self.at - self.at[0]
        one = np.ones(1, np.uint64)
        power = np.concatenate((one, np.cumprod(np.full(len(self.raw), BASE, np.uint64), dtype=np.uint64)))
        self.back = np.concatenate((one, np.cumprod(np.full(len(self.raw), BACK, np.uint64), dtype=np.uint64)))
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((self.raw.astype(np.uint64) + one) * power[:-1], dtype=np.uint64)))

    def slots(self, at: np.ndarray, size: int | np.ndarray, bits: int) -> np.ndarray:
        """The top ``bits`` bits of the hash of the ``size`` bytes from each place on: equal wherever equal bytes stand."""
        value = (self.sums[at + size] - self.sums[at]) * self.back[at]
        return (_spread(value + np.asarray(size).astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


@dataclass(frozen=True)
class NameFilter:
    """Which parts of a text may be names: their lengths, first bytes and hashes, in bit sets of bounded size."""

    sizes: np.ndarray
    heads: np.ndarray
    names: np.ndarray
    bits: int

    def parts(self, texts: pa.Array) -> list[tuple[int, str]]:
        """(text, part) of every part that may be a name, once a text."""
        held = Bytes(texts)
        ends = np.repeat(held.at[1:], np.diff(held.at))
        room = ends - np.arange(len(ends))
        at = np.flatnonzero(room >= HEAD)
        at = at[_is_set(self.heads, held.slots(at, HEAD, HEAD_BITS))]
        found: set[tuple[int, str]] = set()
        for size in self.sizes.tolist():
            here = at[room[at] >= size]
            here = here[_is_set(self.names, held.slots(here, size, self.bits))]
            for text, start in zip((np.searchsorted(held.at, here, "right") - 1).tolist(), here.tolist(), strict=True):
                try:
                    found.add((text, held.raw[start : start + size].tobytes().decode()))
                except UnicodeDecodeError:  # not whole characters, so no name
                    continue
        return list(found)


def _is_set(bitmap: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (bitmap[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def name_filter(people: DataFrame) -> NameFilter:
    """The filter of ``name``: one aggregate of bit sets; its size follows the number of names up to 2^``MOST_BITS`` bits."""
    bits = min(MOST_BITS, max(16, 4 + int(people.count()).bit_length()))

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            held = Bytes(batch.column(0))
            at, size = held.at[:-1], np.diff(held.at)
            kinds = np.repeat(np.arange(3, dtype=np.int32), len(at))
            values = np.concatenate((size, held.slots(at, HEAD, HEAD_BITS), held.slots(at, size, bits)))
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(values)], ["kind", "value"])

    marked = people.select("name").mapInArrow(marks, "kind int, value long")
    sets = marked.groupBy("kind", F.shiftright("value", 15).alias("bucket")).agg(F.bitmap_construct_agg(F.col("value") % 32768).alias("bits"))
    wide = {0: 0, 1: 1 << (HEAD_BITS - 3), 2: 1 << (bits - 3)}
    rows = sets.collect()  # at most 2^(MOST_BITS - 15) bit sets of 4 KB and a few
    wide[0] = 4096 * (1 + max([r["bucket"] for r in rows if r["kind"] == 0], default=0))
    filled = {kind: np.zeros(max(size, 4096), np.uint8) for kind, size in wide.items()}
    for r in rows:
        filled[r["kind"]][r["bucket"] * 4096 : (r["bucket"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    sizes = np.flatnonzero(np.unpackbits(filled[0], bitorder="little"))
    return NameFilter(sizes, filled[1], filled[2], bits)


def _candidates(df: DataFrame, table: str, wanted: Broadcast) -> DataFrame | None:
    """(table_name, column_name, name, rows) of the parts of the table's text cells that pass the filter of names."""
    columns = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    if not columns:
        return None

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, str, int]] = []
            for column, cells in zip(columns, batch.columns, strict=True):
                if cells.null_count == len(cells):
                    continue
                counted = pa.compute.value_counts(cells.drop_null())  # a text that repeats in the batch is looked through once
                texts, times = counted.field(0), counted.field(1).to_pylist()
                out += [(column, part, times[text]) for text, part in wanted.value.parts(texts)]
            if out:
                kinds = [pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["column_name", "name", "rows"])

    found = df.select(*columns).mapInArrow(scan, "column_name string, name string, rows long")
    return found.select(F.lit(table).alias("table_name"), "column_name", "name", "rows")


def leak_scan(pii: DataFrame, tables: Mapping[str, DataFrame], names: list[str] | None = None) -> DataFrame:
    """Raw vault names found anywhere inside the text columns of the given tables, with the number of rows that hold them.

    A name is found as a substring, also inside a longer word (``x_Rahul Sharmas``). Texts are looked through where
    they are read: every part as long as some name whose hash is in a bit set of the names' hashes (``name_filter``,
    of bounded size, broadcast) is a candidate, and candidates are joined with the names themselves. No text is
    shuffled or cut into rows, and no name meets every text; a hash that two parts share only adds a candidate.
    """
    people = pii.select(F.col("cust_name").alias("name")).where(F.length("name") >= LEAST_NAME_LENGTH).distinct()
    wanted = pii.sparkSession.sparkContext.broadcast(name_filter(people))
    parts = [_candidates(tables[n], n, wanted) for n in names or list(tables)]
    candidates = reduce(DataFrame.unionByName, [p for p in parts if p is not None])
    counted = candidates.groupBy("table_name", "column_name", "name").agg(F.sum("rows").alias("leaked_rows"))
    return counted.join(people.hint("merge"), "name", "left_semi").select("table_name", "column_name", "name", "leaked_rows")
