"""Column types and date layouts taken from the data, in one aggregate over the text.

A cell is of one class: missing, whole number, whole number beyond 64 bits,
other number, truth value, or text. A column's state is the set of classes
seen, one bit each, so tasks merge their states with a bitwise or, in any
order, and states of two loads merge the same way; the type is read off the
set at the end. The lattice is long < double < text and boolean < text.

A date column keeps, beside its number of cells, how many of them each known
layout reads, and the first cell in file order with the layouts that read
it. Counts add up and the smaller position wins, so these merge too.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kickledger.functions.coerce import DATE_FORMAT, MISSING_MARKERS, NUMBER_PATTERN, apart, to_date_or_null, to_timestamp_or_null

MISSING, LONG, WIDE, DOUBLE, BOOLEAN, TEXT = (1 << k for k in range(6))

# Shapes of cells beside NUMBER_PATTERN, and cells that are truth values.
WHOLE_PATTERN = r"^\s*[+-]?[0-9]+\s*$"
INFINITE_PATTERN = r"^\s*[+-]?(?i:inf|infinity)\s*$"
TRUTH_VALUES = ("True", "TRUE", "true", "False", "FALSE", "false")

# Known date layouts with the shape of their cells. Where a cell
# fits two of them the earlier one counts: month before day.
LAYOUTS = {
    "yyyy-MM-dd": r"^\d{4}-\d{2}-\d{2}$",
    "yyyy-MM-dd HH:mm:ss": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$",
    "yyyy-MM-dd'T'HH:mm:ss": r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$",
    "yyyy-MM-dd HH:mm": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}$",
    "yyyy/M/d": r"^\d{4}/\d{1,2}/\d{1,2}$",
    "yyyyMMdd": r"^\d{8}$",
    "M/d/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$",
    "d/M/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$",
    "M/d/yyyy HH:mm:ss": r"^\d{1,2}/\d{1,2}/\d{4} \d{2}:\d{2}:\d{2}$",
    "d/M/yyyy HH:mm:ss": r"^\d{1,2}/\d{1,2}/\d{4} \d{2}:\d{2}:\d{2}$",
    "M.d.yyyy": r"^\d{1,2}\.\d{1,2}\.\d{4}$",
    "d.M.yyyy": r"^\d{1,2}\.\d{1,2}\.\d{4}$",
    "d.M.yyyy HH:mm:ss": r"^\d{1,2}\.\d{1,2}\.\d{4} \d{2}:\d{2}:\d{2}$",
    "M-d-yyyy": r"^\d{1,2}-\d{1,2}-\d{4}$",
    "d-M-yyyy": r"^\d{1,2}-\d{1,2}-\d{4}$",
    "MMM d, yyyy": r"^[A-Z][a-z]{2} \d{1,2}, \d{4}$",
    "d MMM yyyy": r"^\d{1,2} [A-Z][a-z]{2} \d{4}$",
}


def _class_by_pattern(cell: Column) -> Column:
    return (F.when(cell.rlike(WHOLE_PATTERN), F.when(F.trim(cell).try_cast("bigint").isNotNull(), F.lit(LONG))
                   .otherwise(F.lit(WIDE)))
            .when(cell.rlike(NUMBER_PATTERN) | cell.rlike(INFINITE_PATTERN), F.lit(DOUBLE))
            .when(cell.isin(*TRUTH_VALUES), F.lit(BOOLEAN)).otherwise(F.lit(TEXT)))


def cell_class(cell: Column, missing: tuple[str, ...] = MISSING_MARKERS) -> Column:
    """The class bit of a text cell.

    Most cells show their class without a pattern: digits alone, digits
    followed by what no number goes on with, or a first letter that begins
    neither an infinity nor a truth value. The patterns are for the others.
    """
    gone = cell.isNull() | cell.isin(*missing) if missing else cell.isNull()
    first, rest = F.ascii(cell), F.ltrim(cell, F.lit("0123456789"))
    begun = first.between(ord("0"), ord("9"))
    goes_on = F.ascii(rest).isin(*map(ord, ".eE \t\n\x0b\f\r"))
    letter = first.between(ord("A"), ord("Z")) | first.between(ord("a"), ord("z"))
    return (F.when(gone, F.lit(MISSING))
            .when(begun & (rest == ""), F.when(F.length(cell) <= 18, F.lit(LONG)).otherwise(apart(cell, _class_by_pattern)))
            .when(begun & ~goes_on, F.lit(TEXT))
            .when(letter & ~first.isin(*map(ord, "iItTfF")), F.lit(TEXT))
            .otherwise(apart(cell, _class_by_pattern)))


def kind_of(state: int) -> str:
    """The type a column of this state gets from the loader.

    Whole numbers with missing cells become doubles, and truth values with
    missing cells text, because the loader's whole numbers and truth values
    have no missing value. A column of missing cells alone is double, one
    without any cell text; whole numbers beyond 64 bits stay text.
    """
    seen = state & ~MISSING
    if state == 0 or seen & (TEXT | WIDE):
        return "string"
    if seen & BOOLEAN:
        return "boolean" if state == BOOLEAN else "string"
    return "long" if state == LONG else "double"


def _month_fits(cell: Column, layout: str) -> Column | None:
    """Is the month of a cell of this layout's shape 12 at most? None for layouts whose month is no number beside the day.

    A date that can't be is costly to find by parsing: it is an error there.
    """
    day_first = layout.startswith("d")
    sep = layout.lstrip("Md")[:1] if layout[0] in "Md" and "MMM" not in layout else ""
    if not sep:
        return None
    number = F.substring_index(F.substring_index(cell, sep, 2), sep, -1) if day_first else F.substring_index(cell, sep, 1)
    return F.length(number).between(1, 2) & (F.lpad(number, 2, "0") <= "12")


def _layout_reads(cell: Column, layout: str, shaped: Column | None = None) -> Column:
    """Does the layout read the cell? ``shaped``: what is known to hold of it, by default that its shape is tried."""
    shaped = cell.rlike(LAYOUTS[layout]) if shaped is None else shaped
    fits = _month_fits(cell, layout)
    shaped = shaped if fits is None else shaped & fits
    return F.coalesce(F.when(shaped, to_timestamp_or_null(cell, layout).isNotNull()), F.lit(False))


def _layout_bits(cell: Column) -> Column:
    """The layouts that read a cell, one bit each, in the order of LAYOUTS.

    Cells of the usual layout are tried against no other, and stay in the
    loop that reads the rows.
    """
    usual = F.lit(1 << list(LAYOUTS).index(DATE_FORMAT))
    return F.when(to_date_or_null(cell).isNotNull(), usual).otherwise(apart(cell, _other_layout_bits))


def _other_layout_bits(cell: Column) -> Column:
    """The bits of a cell that the usual layout does not read: it has one shape, so no others are tried once one fits."""
    bits, others = F, [name for name in LAYOUTS if name != DATE_FORMAT]
    for mark in ("/", ".", ","):  # a cell with the mark has no shape without it
        marked = [name for name in others if mark in name]
        bits = bits.when(cell.contains(mark), _bits_by_shape(cell, marked))
        others = [name for name in others if name not in marked]
    return bits.otherwise(_bits_by_shape(cell, others))


def _bits_by_shape(cell: Column, layouts: list[str]) -> Column:
    names, bits = list(LAYOUTS), F
    for shape in dict.fromkeys(LAYOUTS[name] for name in layouts):
        read = F.lit(0)
        for name in layouts:
            if LAYOUTS[name] == shape:
                read = read + F.when(_layout_reads(cell, name, F.lit(True)), F.lit(1 << names.index(name))).otherwise(F.lit(0))
        bits = bits.when(cell.rlike(shape), read)
    return bits.otherwise(F.lit(0))


@dataclass
class DateLayout:
    """What is known of a date column: cells that are not missing, those each layout reads, and the first cell."""

    cells: int = 0
    votes: dict[str, int] = field(default_factory=dict)
    first: tuple | None = None  # (file, offset, row, cell, layouts that read it as bits)

    def merge(self, other: DateLayout) -> DateLayout:
        firsts = [f for f in (self.first, other.first) if f is not None]
        return DateLayout(self.cells + other.cells,
                          {name: self.votes.get(name, 0) + other.votes.get(name, 0) for name in LAYOUTS},
                          min(firsts) if firsts else None)

    def chosen(self, rule: str = "first") -> str | None:
        """The layout the column is read with; None where no known layout reads a cell of it.

        ``first``: the earliest layout that reads the first cell, as the
        loader does, and if none reads it the one that reads most.
        ``vote``: the one that reads most cells, of equal ones the earliest.
        """
        if rule not in ("first", "vote"):
            raise ValueError(f"rule must be 'first' or 'vote', not {rule!r}")
        if rule == "first" and self.first is not None:
            for k, name in enumerate(LAYOUTS):
                if self.first[-1] >> k & 1:
                    return name
        best = max(LAYOUTS, key=lambda name: self.votes.get(name, 0))
        return best if self.votes.get(best, 0) else None


@dataclass
class Profile:
    """States of columns (``classes``) and of date columns (``dates``)."""

    classes: dict[str, int]
    dates: dict[str, DateLayout]

    def merge(self, other: Profile) -> Profile:
        names = list(self.classes) + [n for n in other.classes if n not in self.classes]
        dates = list(self.dates) + [n for n in other.dates if n not in self.dates]
        return Profile({n: self.classes.get(n, 0) | other.classes.get(n, 0) for n in names},
                       {n: self.dates.get(n, DateLayout()).merge(other.dates.get(n, DateLayout())) for n in dates})

    def kinds(self) -> dict[str, str]:
        return {name: kind_of(state) for name, state in self.classes.items()}

    def layouts(self, rule: str = "first", on_unknown: str = "raise") -> dict[str, str]:
        """Layout per date column; one without cells keeps ``yyyy-MM-dd``.

        A column whose cells no known layout reads is an error, or with
        ``on_unknown="null"`` a column of NULLs with a warning. Where another
        layout reads more cells than the chosen one, a warning gives both
        numbers: no file turns to NULL in silence.
        """
        if on_unknown not in ("raise", "null"):
            raise ValueError(f"on_unknown must be 'raise' or 'null', not {on_unknown!r}")
        found = {}
        for name, date in self.dates.items():
            layout = date.chosen(rule)
            if layout is None and date.cells:
                text = f"no known date layout reads a cell of column {name!r} ({date.cells} cells)"
                if on_unknown == "raise":
                    raise ValueError(text + "; give date_format")
                warnings.warn(text, stacklevel=2)
            elif layout is not None:
                best = date.chosen("vote")
                if date.votes[best] > date.votes[layout]:
                    warnings.warn(f"column {name!r} is read as {layout!r} ({date.votes[layout]} of {date.cells} "
                                  f"cells); {best!r} would read {date.votes[best]}", stacklevel=2)
            found[name] = layout or DATE_FORMAT
        return found


def _numbered(df: DataFrame, names: list[str], with_place: bool) -> DataFrame:
    """The named columns as c0, c1, ..., and with them each cell's place in the files: file, offset of the split, row."""
    cells = [F.col(f"`{name}`").alias(f"c{k}") for k, name in enumerate(names)]
    if not with_place:
        return df.select(*cells)
    row = F.monotonically_increasing_id().alias("row")
    try:
        return df.select(*cells, F.col("_metadata.file_path").alias("file"),
                         F.col("_metadata.file_block_start").alias("offset"), row)
    except AnalysisException:  # not a frame of files
        return df.select(*cells, F.lit("").alias("file"), F.lit(0).cast("long").alias("offset"), row)


def _here(cell: Column, missing: tuple[str, ...]) -> Column:
    return cell.isNotNull() & ~cell.isin(*missing) if missing else cell.isNotNull()


def _first_cell(df: DataFrame, name: str, file: str, missing: tuple[str, ...]) -> str:
    """The first cell of ``file`` that is not missing: splits of one file are read in order, and no further than to it."""
    rows = df.where(F.col("_metadata.file_path") == F.lit(file)) if file else df
    return rows.select(F.col(f"`{name}`").alias("cell")).where(_here(F.col("cell"), missing)).first().cell


def profile(df: DataFrame, columns: list[str] | None = None, date_columns: list[str] | None = None,
            missing: tuple[str, ...] = MISSING_MARKERS) -> Profile:
    """States of the text ``columns`` and ``date_columns`` of ``df``: one pass over just these columns, one row back."""
    columns, date_columns = columns or [], date_columns or []
    if not columns and not date_columns:
        return Profile({}, {})
    wanted = list(dict.fromkeys([*columns, *date_columns]))
    placed = _numbered(df, wanted, bool(date_columns))
    names = list(LAYOUTS)
    classes = [F.bit_or(cell_class(F.col(f"c{wanted.index(name)}"), missing)).alias(f"class_{k}")
               for k, name in enumerate(columns)]
    if not date_columns:
        row = placed.agg(*classes).first()
        return Profile({name: row[f"class_{k}"] or 0 for k, name in enumerate(columns)}, {})
    for k, name in enumerate(date_columns):
        cell = F.col(f"c{wanted.index(name)}")
        placed = placed.withColumn(f"reads_{k}", F.when(_here(cell, missing), _layout_bits(cell)))
    # Rows fold by split and layouts first, all in numbers: a minimum of structs with text would be taken row by row.
    reads = [f"reads_{k}" for k in range(len(date_columns))]
    folded = placed.groupBy("file", "offset", F.shiftright("row", 33).alias("task"), *reads).agg(
        *classes, F.count("*").alias("n"), F.min("row").alias("row"))
    aggs = [F.bit_or(f"class_{k}").alias(f"class_{k}") for k in range(len(columns))]
    for k, bits in enumerate(reads):
        seen = F.col(bits).isNotNull()
        aggs.append(F.sum(F.when(seen, F.col("n"))).alias(f"cells_{k}"))
        aggs += [F.sum(F.when(F.col(bits).bitwiseAND(F.lit(1 << j)) != 0, F.col("n"))).alias(f"votes_{k}_{j}")
                 for j in range(len(names))]
        aggs.append(F.min(F.when(seen, F.struct("file", "offset", "row", F.col(bits).alias("reads")))).alias(f"first_{k}"))
    row = folded.agg(*aggs).first()
    dates = {}
    for k, name in enumerate(date_columns):
        first = row[f"first_{k}"]
        if first is not None:
            first = (first.file, first.offset, first.row, _first_cell(df, name, first.file, missing), first.reads)
        dates[name] = DateLayout(row[f"cells_{k}"] or 0,
                                 {layout: row[f"votes_{k}_{j}"] or 0 for j, layout in enumerate(names)}, first)
    return Profile({name: row[f"class_{k}"] or 0 for k, name in enumerate(columns)}, dates)
