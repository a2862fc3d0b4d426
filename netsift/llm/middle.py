"""Fill-in-middle transformation by displacement scatter.

A text is cut after two numbers of lines that follow from a hash of its id alone; the three
parts are put out as prefix, suffix, middle or as suffix, prefix, middle, each behind its mark.

The texts of a batch are one run of bytes. Their cuts give, for each part, by how much its bytes
move on their way into the run of all outputs. A difference array holds the change of that
shift where a part starts, its cumulative sum the shift of every byte, and one numpy
scatter moves them all. The way back finds the marks in the outputs, makes the shifts of the
restored text from them and gathers. Shifts are laid out in windows of ``WINDOW`` bytes, so
a text of any length needs little more than itself and its output.

Nothing is shuffled; a partition computed again gives the same rows.

Cases: a null text counts as empty; an empty text, one that contains a mark and one that the
rate leaves out stay as they are (``plain``); a null id is hashed as no digits and stays null;
rows of equal id are cut by the same hash; an empty table gives no rows; other columns are not
read. The column ``output`` is never null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netsift.llm.common import read

# The marks of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
WINDOW = 1 << 20
CHUNK_BYTES = 4 << 20
PLAIN, PSM, SPM = 0, 1, 2
FORMS = np.array(["plain", "psm", "spm"], object)


def _strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column in one run, and the bounds of its texts there."""
    column = column.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def _column(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data))


def _chunks(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    """Slices of batches with some ``CHUNK_BYTES`` of text, or one row."""
    for batch in batches:
        _, bounds = _strings(batch.column(batch.schema.get_field_index(name)))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + CHUNK_BYTES, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def shifts(starts: np.ndarray, moves: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Per window of ``size`` positions: its bounds and where each position moves to.

    ``starts`` are positions in rising order, ``moves`` the shift that holds from each one on.
    """
    changes = np.diff(moves, prepend=0)
    shift = 0
    for at in range(0, size, WINDOW):
        end = min(at + WINDOW, size)
        low, high = np.searchsorted(starts, [at, end])
        difference = np.zeros(end - at, np.int64)
        np.add.at(difference, starts[low:high] - at, changes[low:high])
        difference[0] += shift
        np.cumsum(difference, out=difference)
        shift = int(difference[-1])
        difference += np.arange(at, end)
        yield at, end, difference


def _find_marks(data: np.ndarray, letters: bytes) -> np.ndarray:
    """Positions of ``<x>`` with x among ``letters``, across the bounds of texts too."""
    if len(data) < 3:
        return np.zeros(0, np.int64)
    at = np.flatnonzero((data[:-2] == ord("<")) & (data[2:] == ord(">")))
    return at[np.isin(data[at + 1], np.frombuffer(letters, np.uint8))]


def _marks(marks: tuple[str, str, str]) -> bytes:
    letters = "".join(m[1:-1] for m in marks).encode()
    if len(letters) != 3 or len(set(letters)) != 3 or any(m != f"<{m[1:-1]}>" for m in marks):
        raise ValueError("marks are three different ASCII letters in angle brackets")
    return letters


def cut_points(data: np.ndarray, bounds: np.ndarray, first: np.ndarray, second: np.ndarray):
    """Lines of each text, and the byte positions of its two cuts."""
    starts, ends = bounds[:-1], bounds[1:]
    breaks = np.flatnonzero(data == ord("\n"))
    before = np.searchsorted(breaks, starts)
    inside = np.searchsorted(breaks, ends) - before
    open_end = ends > starts
    open_end[open_end] = data[ends[open_end] - 1] != ord("\n")
    lines = inside + open_end
    breaks = np.append(breaks, 0)

    def position(units: np.ndarray) -> np.ndarray:
        at = np.where(units <= inside, breaks[np.clip(before + units - 1, 0, len(breaks) - 1)] + 1, ends)
        return np.where(units == 0, starts, at)

    a, b = first % (lines + 1), second % (lines + 1)
    return lines, position(np.minimum(a, b)), position(np.maximum(a, b))


def scatter(data: np.ndarray, bounds: np.ndarray, low: np.ndarray, high: np.ndarray, form: np.ndarray, letters: bytes):
    """All outputs in one run of bytes, and their bounds."""
    starts, ends = bounds[:-1], bounds[1:]
    moved = form != PLAIN
    sizes = ends - starts + 9 * moved
    out_bounds = np.concatenate([[0], np.cumsum(sizes)])
    base = out_bounds[:-1]
    psm = form == PSM
    # where each part starts in the output, behind its mark
    prefix = np.where(psm, base + 3, base + 6 + ends - high)
    suffix = np.where(psm, base + 6 + low - starts, base + 3)
    middle = base + 9 + (low - starts) + (ends - high)
    at = np.stack([starts, np.where(moved, low, starts), np.where(moved, high, starts)], 1)
    to = np.stack([np.where(moved, prefix, base), np.where(moved, middle, base), np.where(moved, suffix, base)], 1)
    out = np.empty(int(out_bounds[-1]), np.uint8)
    for a, b, target in shifts(at.ravel(), (to - at).ravel(), len(data)):
        out[target] = data[a:b]
    for letter, part in zip(letters, (prefix, suffix, middle)):
        part = part[moved]
        out[part - 3], out[part - 2], out[part - 1] = ord("<"), letter, ord(">")
    return out, out_bounds


def gather(out: np.ndarray, out_bounds: np.ndarray, form: np.ndarray, letters: bytes):
    """The texts that outputs were made of, in one run of bytes, and their bounds."""
    moved = form != PLAIN
    marks = _find_marks(out, letters)
    owner = np.searchsorted(out_bounds, marks, "right") - 1
    marks = marks[moved[owner] & (marks + 3 <= out_bounds[owner + 1])].reshape(-1, 3)
    if len(marks) != moved.sum():
        raise ValueError("an output that is not plain needs its three marks once each")
    ends = out_bounds[1:]
    one, two, three = np.zeros((3, len(form)), np.int64)
    one[moved], two[moved], three[moved] = marks.T
    psm = form == PSM
    first, second = two - one - 3, three - two - 3  # sizes of the parts behind the first and second mark
    n_prefix, n_suffix = np.where(psm, first, second), np.where(psm, second, first)
    sizes = np.diff(out_bounds) - 9 * moved
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    starts = bounds[:-1]
    high = bounds[1:] - n_suffix
    at = np.stack([starts, np.where(moved, starts + n_prefix, starts), np.where(moved, high, starts)], 1)
    prefix, suffix = np.where(psm, one, two) + 3, np.where(psm, two, one) + 3
    whole = ends - sizes
    came = np.stack([np.where(moved, prefix, whole), np.where(moved, three + 3, whole), np.where(moved, suffix, whole)], 1)
    data = np.empty(int(bounds[-1]), np.uint8)
    for a, b, source in shifts(at.ravel(), (came - at).ravel(), len(data)):
        data[a:b] = out[source]
    return data, bounds


def _characters(data: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Code points between two byte positions: the bytes that do not continue one."""
    return np.array([np.count_nonzero(data[a:b] & 0xC0 != 0x80) for a, b in zip(low.tolist(), high.tolist())], np.int64)


def fill_in_middle(
    docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, marks: tuple[str, str, str] = MARKS,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``: one row per text.

    ``rate`` percent of the texts are transformed, ``spm`` percent of those with the suffix first.
    """
    letters = _marks(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, "text"):
            data, bounds = _strings(chunk.column("text"))
            h = [np.asarray(chunk.column(f"h{i}")) for i in range(1, 5)]
            lines, low, high = cut_points(data, bounds, h[0], h[1])
            form = np.where(h[3] % 100 < spm, SPM, PSM)
            form[(h[2] % 100 >= rate) | (np.diff(bounds) == 0)] = PLAIN
            found = _find_marks(data, letters)
            owner = np.searchsorted(bounds, found, "right") - 1
            form[owner[found + 3 <= bounds[owner + 1]]] = PLAIN
            out = _column(*scatter(data, bounds, low, high, form, letters))
            plain = form == PLAIN
            counts = [pa.array(_characters(data, *part), mask=plain) for part in ((bounds[:-1], low), (low, high))]
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), pa.array(lines, pa.int64()), pa.array(FORMS[form], pa.string()), *counts, out],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit(""))), 256)
    groups = [F.conv(F.substring("hash", 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    needed = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"), digits.alias("hash"))
    return needed.select("doc_id", "text", *groups).mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def restore(outputs: DataFrame, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """``outputs`` with the column ``restored``: the text before, made of ``output`` and ``form`` alone."""
    letters = _marks(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, "output"):
            out, bounds = _strings(chunk.column("output"))
            form = np.asarray(chunk.column("form").to_numpy(zero_copy_only=False))
            form = np.select([form == "psm", form == "spm"], [PSM, SPM], PLAIN)
            yield chunk.append_column("restored", _column(*gather(out, bounds, form, letters)))

    return outputs.mapInArrow(run, T.StructType([*outputs.schema.fields, T.StructField("restored", T.StringType())]))


def op13_displacement_middle(spark: SparkSession, folder: str) -> DataFrame:
    rows = restore(fill_in_middle(read(spark, folder, "documents")))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


OP13_SQL = r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(cast(doc_id AS VARCHAR), '')) AS h FROM documents
), cut AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS lines,
    ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
    ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
  FROM hashed
), sized AS (
  SELECT *, CAST(len(lines) AS BIGINT) AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS a,
    greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS b,
    CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR h3 % 100 >= 100 THEN 'plain'
      WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM cut
), parts AS (
  SELECT doc_id, text, n, form, array_to_string(lines[1:a], '') AS p,
    array_to_string(lines[a + 1:b], '') AS m, array_to_string(lines[b + 1:], '') AS s
  FROM sized
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""
