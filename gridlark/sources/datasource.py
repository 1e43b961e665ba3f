"""spark.read.format("xlsx"): a sheet as a Spark data source; save() for the way back."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructField, StructType

from gridlark.errors import OperationalError
from gridlark.sources import inference
from gridlark.sources.catalog import spark_type
from gridlark.sources.xlsx import Sheet, read_workbook


def _sheet(options) -> Sheet:
    sheets = read_workbook(options["path"], cached_values=options.get("dataOnly", "true").lower() == "true")
    wanted = options.get("sheet")
    if wanted is None:
        return sheets[0]
    found = [s for s in sheets if s.name.casefold() == wanted.casefold()]
    if not found:
        raise OperationalError(f"No sheet {wanted!r}; there are {', '.join(s.name for s in sheets)}")
    return found[0]


class XlsxDataSource(DataSource):
    """Options: path, sheet (the first by default), dataOnly."""

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def schema(self) -> StructType:
        sheet = _sheet(self.options)
        kinds = [inference.column_kind([r[i] for r in sheet.rows])[0] for i in range(len(sheet.headers))]
        return StructType([StructField(h, spark_type(k)) for h, k in zip(sheet.headers, kinds, strict=True)])

    def reader(self, schema: StructType) -> DataSourceReader:
        return XlsxReader(dict(self.options))


class XlsxReader(DataSourceReader):
    """One partition: a workbook is one compressed stream."""

    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        sheet = _sheet(self.options)
        kinds = [inference.column_kind([r[i] for r in sheet.rows])[0] for i in range(len(sheet.headers))]
        for row in sheet.rows:
            yield tuple(inference.as_kind(x, k) for x, k in zip(row, kinds, strict=True))


def register(spark) -> None:
    spark.dataSource.register(XlsxDataSource)


def save(df, path: str, sheet: str = "Sheet1") -> None:
    """A DataFrame as a workbook of one sheet, its rows streamed through the driver."""
    from gridlark.sources.xlsx import write_workbook

    write_workbook(path, [(sheet, df.columns, (list(r) for r in df.toLocalIterator()))])
