"""Map extracts as a Python data source; reading one needs the optional reader library."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class MapExtractSource(DataSource):
    """``spark.read.format("map_extract").load(path)``: osm_type, osm_id, tags of nodes, ways and relations in file order."""

    @classmethod
    def name(cls) -> str:
        return "map_extract"

    def schema(self) -> str:
        return "osm_type string, osm_id bigint, tags map<string,string>"

    def reader(self, schema) -> DataSourceReader:
        return _MapExtractReader(self.options["path"])


class _MapExtractReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(self.path)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        try:
            import osmium
        except ImportError as e:
            raise RuntimeError("reading map extracts needs the osmium library") from e
        kinds = {"n": "node", "w": "way", "r": "relation"}
        for item in osmium.FileProcessor(partition.value):
            kind = kinds.get(item.type_str())
            if kind and len(item.tags):
                yield kind, item.id, {t.k: t.v for t in item.tags}


def register(spark) -> None:
    spark.dataSource.register(MapExtractSource)
