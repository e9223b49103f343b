"""Roll sources: plug-ins that turn a state's raw files into normalised records."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlight.functions import normalize as nz
from ledgerlight.operators.audit import FIELDS, WIDTH
from ledgerlight.operators import layout
from ledgerlight.operators.layout import word_remark, word_text
from ledgerlight.schema import ROLL_SCHEMA
from ledgerlight.storage import stored

from . import files, pages
from .links import with_source_url


class RollSource(Protocol):
    """Reads the raw files under a path; constituency has the areas' reference names."""

    state: str

    def read(self, spark: SparkSession, path: str, constituency: DataFrame, roll_year: int) -> DataFrame: ...


@dataclass(frozen=True)
class Entry:
    """A registered state: label, the glob of its raw files, and the script of its names."""

    source: RollSource
    label: str
    glob: str
    script: str


def finish(rows: DataFrame) -> DataFrame:
    """The record's columns in order, missing ones as '' or null, codes labelled."""
    rows = rows.withColumn("relation_label", nz.relation_label(F.col("relation_code")))
    if "source_url" not in rows.columns:
        rows = with_source_url(rows)
    blank = lambda f: F.lit(None).cast(f.dataType) if f.dataType.simpleString() != "string" or f.name.endswith("_latin") else F.lit("")
    order = [F.col(c) for c in ("file", "line") if c in rows.columns]
    return rows.select(*[F.col(f.name).cast(f.dataType) if f.name in rows.columns else blank(f).alias(f.name) for f in ROLL_SCHEMA.fields], *order)


def with_area(rows: DataFrame, constituency: DataFrame) -> DataFrame:
    """rows with m_name and m_district of their ac_code, null where the area is unknown."""
    meta = constituency.select(F.col("ac_code").alias("m_code"), F.col("ac_name").alias("m_name"), F.col("district").alias("m_district"))
    return rows.join(meta, F.col("ac_code") == F.col("m_code"), "left").drop("m_code")


@dataclass(frozen=True)
class DelimitedSource:
    """Headerless delimited files, one per area, named after it. Every row that isn't blank is kept."""

    state: str

    def read(self, spark: SparkSession, path: str, constituency: DataFrame, roll_year: int) -> DataFrame:
        return self.normalized(files.delimited_rows(files.raw_files(spark, path, "*.csv")), constituency, roll_year)

    def normalized(self, rows: DataFrame, constituency: DataFrame, roll_year: int) -> DataFrame:
        rows = rows.where((F.size("cols") > 0) & ~F.forall("cols", lambda c: nz.strip(c) == ""))
        rows = with_area(rows.withColumn("ac_code", files.area_of(F.col("file"))), constituency)
        at = {f: nz.clean(F.get("cols", i)) for i, f in enumerate(FIELDS)}
        size = F.size("cols")
        tail = F.exists(F.slice("cols", WIDTH + 1, F.greatest(size - WIDTH, F.lit(0))), lambda c: nz.strip(c) != "")
        widths = F.when(size < WIDTH, F.concat(F.lit("malformed row: only "), size.cast("string"), F.lit(f" columns (expected {WIDTH})")))
        widths = widths.when((size > WIDTH) & tail, F.concat(F.lit("malformed row: "), size.cast("string"), F.lit(" columns with non-empty trailing data")))
        numbers = {f: nz.integer(at[f], f) for f in ("part_no", "serial_no", "age")}
        relation = nz.lookup(at["relation_code"], nz.RELATIONS["csv"], "relation_code")
        gender = nz.lookup(at["gender"], nz.GENDERS["csv"], "gender")
        # remarks in the order in which the fields are read
        found = [widths, nz.area_code(at["ac_code"], F.col("ac_code")), *[numbers[f][1] for f in ("part_no", "serial_no", "age")], relation[1], gender[1]]
        return finish(
            rows.select(
                "file", "line", "ac_code",
                F.lit(self.state).alias("state"),
                F.lit(roll_year).alias("roll_year"),
                nz.authority(F.col("m_district"), at["district"]).alias("district"),
                nz.authority(F.col("m_name"), at["ac_name"]).alias("ac_name"),
                *[numbers[f][0].alias(f) for f in numbers],
                at["local_ref"].alias("local_ref"),
                nz.joined(at["first_name"], at["first_suffix"]).alias("full_name"),
                nz.joined(at["relative_name"], at["relative_suffix"]).alias("full_relative_name"),
                relation[0].alias("relation_code"),
                gender[0].alias("gender"),
                nz.remarks(*found).alias("remark"),
            )
        )


def _known(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def _part_record(rows: DataFrame, state: str, roll_year: int, part: Column, fields: dict[str, Column], found: list[Column]) -> DataFrame:
    return finish(
        rows.select(
            "file", "line", "ac_code",
            F.lit(state).alias("state"),
            F.lit(roll_year).alias("roll_year"),
            _known("m_district").alias("district"), _known("m_name").alias("ac_name"),
            part.alias("part_no"), _known("locality").alias("locality"),
            *[v.alias(k) for k, v in fields.items()],
            nz.remarks(*found).alias("remark"),
        )
    )


def part_items(spark: SparkSession, path: str, pattern: str, reader: pages.PageReader) -> DataFrame:
    """Page items of the part documents in a folder's archives; part_id is the archive's name and the member's."""
    members = files.archive_members(files.raw_files(spark, path, "*.zip"), pattern)
    return pages.page_items(members, reader).withColumn("part_id", F.concat_ws("/", "file", "member"))


def by_file(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows(part_id, …) with file, the part's own id, and line: the row's number in its file, parts in order of their names."""
    rows = rows.withColumns({"file": F.substring_index("part_id", "/", 1), "line": F.row_number().over(Window.partitionBy(F.substring_index("part_id", "/", 1)).orderBy("part_id", *order)).cast("long")})
    return rows.withColumn("part_id", F.regexp_extract("part_id", "([^/]*)$", 1))


@dataclass(frozen=True)
class RuledPartSource:
    """Ruled tables of part documents: (file, part_id, line, cells, locality), cells as ruled_rows() gives them.

    Rows whose first cell is no number are headings and are dropped. Words in the legacy font are decoded.
    """

    state: str
    #: What the columns 1 to 8 hold.
    columns: tuple[str, ...] = ("serial_no", "house", "full_name", "relation", "full_relative_name", "gender", "age", "epic")

    def read(self, spark: SparkSession, path: str, constituency: DataFrame, roll_year: int, reader: pages.PageReader = pages.read_pages) -> DataFrame:
        items = stored(part_items(spark, path, r"part\w+\.(pdf|json)", reader), "pages")
        words = items.where("kind = 'word'").withColumnRenamed("idx", "word_idx")
        return self.from_pages(words, items.where("kind = 'edge'").withColumn("orientation", F.substring("orientation", 1, 1)), constituency, roll_year)

    def from_pages(self, words: DataFrame, edges: DataFrame, constituency: DataFrame, roll_year: int) -> DataFrame:
        """Records of words and ruling lines whose part_id is ``archive/member``. A part's locality, from its first page
        without a table that names one, goes to all its rows."""
        tables = layout.ruled_bounds(words, edges)
        covers = words.join(tables.select(*layout.PAGE), layout.PAGE, "left_anti")
        rows = layout.ruled_rows(words, edges).join(layout.first_locality(layout.cover_locality(covers)), "part_id", "left")
        rows = by_file(rows, ["page_no", "row_no"])
        member = files.member_part(F.col("part_id"))
        return self.normalized(rows.withColumn("part_id", F.when(member != "", member).otherwise(F.col("part_id"))), constituency, roll_year)

    def normalized(self, rows: DataFrame, constituency: DataFrame, roll_year: int) -> DataFrame:
        rows = with_area(rows.withColumn("ac_code", files.area_of(F.col("file"))), constituency)
        cell = {c: F.get("cells", i) for i, c in enumerate(self.columns)}
        # one projection for the decoded cells, so that each is decoded once
        rows = rows.withColumns({f"t_{c}": word_text(cell[c]) for c in self.columns} | {f"r_{c}": word_remark(cell[c], i + 1) for i, c in enumerate(self.columns)})
        rows = rows.where(F.translate("t_serial_no", nz.INDIC_DIGITS, "01234567890123456789").rlike("^[0-9]+$"))
        part, suffix = nz.part_number(F.col("part_id"))
        number, bad_number = nz.integer(F.col("t_serial_no"), "serial_no")
        age, bad_age = nz.integer(F.col("t_age"), "age")
        relation, bad_relation = nz.lookup(F.col("t_relation"), nz.RELATIONS["devanagari"], "relation_code", fold=False, strip_dots=True)
        gender, bad_gender = nz.lookup(F.col("t_gender"), nz.GENDERS["devanagari"], "gender", fold=False, strip_dots=True)
        fields = {"serial_no": number, "local_ref": F.col("t_house"), "full_name": F.col("t_full_name"), "full_relative_name": F.col("t_full_relative_name"), "relation_code": relation, "age": age, "gender": gender}
        first = [suffix, *[F.col(f"r_{c}") for c in ("serial_no", "full_name", "full_relative_name", "house", "epic")]]
        nameless = F.when(F.col("t_full_name") == "", "no voter name in row")
        return _part_record(rows, self.state, roll_year, part, fields, [*first, nameless, bad_number, F.col("r_relation"), bad_relation, F.col("r_age"), bad_age, F.col("r_gender"), bad_gender])


@dataclass(frozen=True)
class GlyphPartSource:
    """Unruled tables of part documents: (file, part_id, line, cells, locality), cells as unruled_rows() gives them.

    Names with glyphs that the font doesn't name are left empty with a remark; relation and sex are closed vocabularies
    that are known by their glyph numbers.
    """

    state: str
    #: The cells' order, and the glyph sequences of the closed vocabularies.
    columns: tuple[str, ...] = ("serial_no", "house", "full_name", "relation", "full_relative_name", "gender", "age", "epic")
    relations = {"C2-7C-57-82-C1": "F", "B2-8D-C1-94-C4": "H", "94-C1-57-82-C1": "M"}
    genders = {"7C-C6-D2": "M", "B2-5F-C4": "F"}
    unread = "name in Bengali script: source font carries no ToUnicode map, so the name columns are not decodable yet"

    def read(self, spark: SparkSession, path: str, constituency: DataFrame, roll_year: int, reader: pages.PageReader = pages.read_pages) -> DataFrame:
        items = part_items(spark, path, ".*", reader)
        return self.from_pages(items.where("kind = 'char'").withColumnRenamed("idx", "char_idx"), constituency, roll_year)

    def from_pages(self, chars: DataFrame, constituency: DataFrame, roll_year: int) -> DataFrame:
        """Records of characters whose part_id is ``archive/member``."""
        rows = layout.unruled_rows(chars.select("part_id", "page_no", "char_idx", "text", "x0", "x1", "top")).withColumnRenamed("line", "row_no")
        return self.normalized(by_file(rows, ["row_no"]), constituency, roll_year)

    def normalized(self, rows: DataFrame, constituency: DataFrame, roll_year: int) -> DataFrame:
        rows = with_area(rows.withColumn("ac_code", files.area_of(F.col("file"))), constituency)
        cell = {c: F.coalesce(F.get("cells", i), F.lit("")) for i, c in enumerate(self.columns)}
        hidden = nz.undecoded(cell["full_name"]) | nz.undecoded(cell["full_relative_name"])
        raw_relation, no_relation = nz.glyph_lookup(cell["relation"], self.relations, "relation_code")
        raw_gender, no_gender = nz.glyph_lookup(cell["gender"], self.genders, "gender")
        relation, bad_relation = nz.lookup(raw_relation, nz.RELATIONS["glyph"], "relation_code")
        gender, bad_gender = nz.lookup(raw_gender, nz.GENDERS["glyph"], "gender")
        number, bad_number = nz.loose_integer(cell["serial_no"], "serial_no")
        age, bad_age = nz.loose_integer(cell["age"], "age")
        epic = F.when(nz.undecoded(cell["epic"]), "").otherwise(cell["epic"])
        bad_epic = F.when(nz.undecoded(cell["epic"]), F.concat(F.lit("unreadable EPIC no: "), nz.masked(cell["epic"])))
        shown = {c: F.when(hidden, "").otherwise(cell[c]) for c in ("full_name", "full_relative_name")}
        fields = {"serial_no": number, "local_ref": epic, **shown, "relation_code": relation, "age": age, "gender": gender}
        part = F.regexp_extract("part_id", r"(\d+)", 1).try_cast("int")
        return _part_record(rows, self.state, roll_year, part, fields, [F.when(hidden, self.unread), no_relation, bad_relation, no_gender, bad_gender, bad_epic, bad_number, bad_age])


#: The states that are known.
REGISTRY: dict[str, Entry] = {
    "karnataka": Entry(DelimitedSource("karnataka"), "Karnataka", "*.csv", "latin"),
    "haryana": Entry(RuledPartSource("haryana"), "Haryana", "*.zip", "devanagari"),
    "west_bengal": Entry(GlyphPartSource("west_bengal"), "West Bengal", "*.zip", "latin"),
}


def states_in_script(script: str, subset: list[str] | None = None) -> list[str]:
    return [s for s, e in REGISTRY.items() if e.script == script and (subset is None or s in subset)]
