"""Helpers shared by the tests: records in arrival order, rows of a result."""

import datetime as dt

from encore import schemas

BASE = dt.datetime(2024, 1, 1)


class Feed:
    """Records in arrival order; the arrival number becomes ``ts`` (seconds after BASE).

    Mirrors the reference tests, which pipe one record after the other.
    """

    def __init__(self):
        self.seq = 0
        self.rows = {name: [] for name in schemas.ENTITIES}
        self.ids = 0

    def add(self, entity, **fields):
        self.seq += 1
        if "id" not in fields:
            self.ids += 1
            fields["id"] = 100_000 + self.ids if entity != "address" else f"gen-{self.ids}"
        fields["ts"] = BASE + dt.timedelta(seconds=self.seq)
        self.rows[entity].append(fields)
        return fields["id"]

    def df(self, spark, entity):
        schema = schemas.ENTITIES[entity]
        data = [tuple(r.get(f.name) for f in schema.fields) for r in self.rows[entity]]
        return spark.createDataFrame(data, schema)


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())
