"""One declaration of the fields of an issue gives its Spark type, its JSON schema and a parser that validates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BROKEN = "_broken"


@dataclass(frozen=True)
class Field:
    """A required text field; with `values` no other is allowed."""

    name: str
    values: tuple[str, ...] | None = None
    description: str = ""


@dataclass(frozen=True)
class Declaration:
    """A list, named `items`, of records of fields, `most` of them at most."""

    items: str
    fields: tuple[Field, ...]
    most: int

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def item_type(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, T.StringType()) for f in self.fields])

    def list_type(self) -> T.ArrayType:
        return T.ArrayType(self.item_type())

    def ddl(self) -> str:
        return self.list_type().simpleString()

    def json_schema(self) -> dict:
        """The tool schema; every field is required."""
        said = lambda f: {"description": f.description} if f.description else {}
        item = {f.name: {"type": "string", **({"enum": list(f.values)} if f.values else {}), **said(f)} for f in self.fields}
        one = {"type": "object", "properties": item, "required": self.names}
        return {"type": "object", "properties": {self.items: {"type": "array", "maxItems": self.most, "items": one}}, "required": [self.items]}

    def parse(self, arguments: Column) -> Column:
        """(items, problems) of tool arguments as JSON text.

        Null and empty arguments are those of no items, and so is an object without them. At most `most` items are kept, in
        their order, with what they say. problems names what breaks the schema: `malformed` for text that is no such JSON
        (which gives no items), `too many`, and for each kept item i (from 0) `i.field missing` or `i.field=value`.
        """
        kind = T.StructType([T.StructField(self.items, self.list_type()), T.StructField(_BROKEN, T.StringType())])
        text = F.coalesce(F.nullif(arguments, F.lit("")), F.lit("{}"))
        held = F.from_json(text, kind, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN})
        return F.transform(F.array(held), self._checked)[0]

    def _checked(self, held: Column) -> Column:
        none = F.array().cast(self.list_type())
        broken = held.isNull() | held[_BROKEN].isNotNull()
        every = F.when(broken, none).otherwise(F.coalesce(held[self.items], none))
        kept = F.slice(every, 1, self.most)
        whole = F.concat(
            F.when(broken, F.array(F.lit("malformed"))).otherwise(F.array().cast("array<string>")),
            F.when(F.size(every) > self.most, F.array(F.lit("too many"))).otherwise(F.array().cast("array<string>")),
        )
        each = F.flatten(F.transform(kept, lambda x, i: F.filter(F.array(*[self._fault(f, x, i) for f in self.fields]), lambda p: p.isNotNull())))
        return F.struct(kept.alias(self.items), F.concat(whole, each).alias("problems"))

    @staticmethod
    def _fault(f: Field, item: Column, i: Column) -> Column:
        place = F.concat(i.cast("string"), F.lit(f".{f.name}"))
        value = item[f.name]
        fault = F.when(value.isNull(), F.concat(place, F.lit(" missing")))
        return fault.when(~value.isin(*f.values), F.concat(place, F.lit("="), value)) if f.values else fault
