"""Replies of labelling models: JSON in exact shapes, checked field against field, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.scalars import let

# Decisions with their two flags (label, foreign material), evidence, and the fields of a reply.
DECISIONS = {"neither": (False, False), "label_only": (True, False), "foreign_only": (False, True), "both": (True, True), "exclude": (None, None), "ambiguous": (None, None)}
EVIDENCE = ["none", "label", "different_material", "contamination", "same_material_accessory", "multiple_items", "unclear"]
FULL = ["decision", "has_removable_label", "has_true_foreign_material", "same_material_accessory_only", "is_single_primary_item", "confidence", "reason"]
LABELLED = ["pet", "plastic"]
FLAGS = ["has_label", "compression_required", "is_dented", "has_straw", "has_cup_holder", "has_foreign_material", "is_single_primary_item"]


def _body(text: Column) -> Column:
    """A text without the code fence around it."""
    return F.regexp_replace(F.trim(text), r"(?s)^```[^\n]*\n(.*?)\n?```$", "$1")


def _keys(text: Column, names: list[str]) -> Column:
    found = F.json_object_keys(text)
    return F.coalesce(F.array_sort(F.array_distinct(found)) == F.array(*map(F.lit, sorted(names))), F.lit(False))


def _field(v: Column, name: str, kind: str) -> Column:
    """A field of a parsed reply if it is of the kind as it stands: bool, number or string."""
    kinds = {"bool": ("boolean", r"^BOOLEAN$"), "number": ("double", r"^(BIGINT|DOUBLE|DECIMAL.*)$"), "string": ("string", r"^STRING$")}[kind]
    return F.when(F.schema_of_variant(F.try_variant_get(v, f"$.{name}", "variant")).rlike(kinds[1]), F.try_variant_get(v, f"$.{name}", kinds[0]))


def _null(v: Column, name: str) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_variant_get(v, f"$.{name}", "variant")) == "VOID", F.lit(False))


def _told(value: Column, reason: Column) -> Column:
    return let(reason, lambda why: F.struct(F.when(why.isNull(), value).alias("value"), why.alias("reason")))


def teacher_reply(text: Column) -> tuple[Column, Column]:
    """(struct, reason) of a teacher's reply in one of three shapes: whole, four letters, or seven letters; the other is null.

    Flags must follow from the decision; an accessory of the same material is not foreign material.
    """

    def read(body: Column) -> Column:
        v = F.try_parse_json(body)
        shape = F.when(_keys(body, ["d", "s", "c", "e"]), 1).when(_keys(body, ["d", "l", "f", "a", "s", "c", "e"]), 2).when(_keys(body, FULL), 3).otherwise(0)
        pick = lambda kind, *names: F.coalesce(*[_field(v, n, kind) for n in names])
        label, foreign = pick("bool", "l", "has_removable_label"), pick("bool", "f", "has_true_foreign_material")
        said, evidence = pick("string", "d", "decision"), pick("string", "e", "reason")
        flags = lambda i: F.coalesce(*[F.when(said == d, F.lit(f[i])) for d, f in DECISIONS.items() if f[i] is not None])
        named = F.coalesce(*[F.when((label == a) & (foreign == b), F.lit(d)) for d, (a, b) in DECISIONS.items() if a is not None])
        nulls = (_null(v, "l") & _null(v, "f")) | (_null(v, "has_removable_label") & _null(v, "has_true_foreign_material"))
        return F.struct(
            shape.alias("shape"), F.coalesce(F.when((shape == 2) & ~nulls, named), said).alias("decision"), F.when(shape == 1, flags(0)).otherwise(label).alias("label"), F.when(shape == 1, flags(1)).otherwise(foreign).alias("foreign_material"), nulls.alias("nulls"),
            F.when(shape == 1, evidence == "same_material_accessory").otherwise(pick("bool", "a", "same_material_accessory_only")).alias("accessory"), pick("bool", "s", "is_single_primary_item").alias("single"), pick("number", "c", "confidence").alias("confidence"), evidence.alias("reason"),
        )

    def judge(r: Column) -> Column:
        open_ = r["decision"].isin("exclude", "ambiguous")
        right = F.coalesce(*[F.when(r["decision"] == d, (r["label"] == a) & (r["foreign_material"] == b)) for d, (a, b) in DECISIONS.items() if a is not None], F.when(open_, r["label"].isNull() & r["foreign_material"].isNull() & ((r["shape"] == 1) | r["nulls"])))
        reason = (
            F.when(r["shape"] == 0, "unexpected_fields").when((r["shape"] < 3) & ~F.coalesce(r["reason"].isin(EVIDENCE), F.lit(False)), "invalid_evidence").when(~F.coalesce(r["decision"].isin(*DECISIONS), F.lit(False)), "invalid_decision")
            .when(r["accessory"].isNull() | r["single"].isNull() | r["reason"].isNull(), "invalid_type").when(r["confidence"].isNull(), "confidence_not_numeric").when(~r["confidence"].between(0, 1), "confidence_out_of_range")
            .when(~F.coalesce(right, F.lit(False)), "decision_flags_mismatch").when(r["accessory"] & F.coalesce(r["foreign_material"], F.lit(False)), "accessory_foreign_conflict")
        )
        return _told(F.struct(*[r[f].alias(f) for f in ("decision", "label", "foreign_material", "accessory", "single", "confidence", "reason")]), reason)

    out = let(let(_body(text), read), judge)
    return out["value"], out["reason"]


def accepted_status(reply: Column, category: Column, least: float) -> Column:
    """(label, foreign_material, eligible): 0 or 1 of an accepted reply, -1 where it says nothing."""
    ok = F.coalesce(~reply["decision"].isin("exclude", "ambiguous") & reply["single"] & (reply["confidence"] >= least), F.lit(False))
    label = F.when(ok & category.isin(LABELLED), reply["label"].cast("int")).otherwise(-1)
    return F.struct(label.alias("label"), F.when(ok, reply["foreign_material"].cast("int")).otherwise(-1).alias("foreign_material"), ok.cast("int").alias("eligible"))


def vision_reply(text: Column, classes: list[str]) -> tuple[Column, Column]:
    """(struct, reason) of a vision model's reply: a class, a confidence and seven flags; of an empty scene no flag holds."""

    def read(body: Column) -> Column:
        v = F.try_parse_json(body)
        flags = [_field(v, n, "bool").alias(n) for n in FLAGS]
        return F.struct(_keys(body, ["material", "confidence", *FLAGS]).alias("whole"), _field(v, "material", "string").alias("material"), _field(v, "confidence", "number").alias("confidence"), *flags)

    def judge(r: Column) -> Column:
        flags = [r[n] for n in FLAGS]
        unset = F.exists(F.array(*flags), lambda x: x.isNull())
        reason = F.when(~r["whole"], "contract_mismatch").when(~F.coalesce(r["material"].isin(classes), F.lit(False)) | r["confidence"].isNull(), "invalid_material_or_confidence").when(~r["confidence"].between(0, 1), "confidence_out_of_range").when(unset, "invalid_boolean")
        return _told(F.struct(r["material"].alias("material"), r["confidence"].alias("confidence"), *[(r[n] & (r["material"] != "empty_scene")).alias(n) for n in FLAGS]), reason)

    out = let(let(text, read), judge)
    return out["value"], out["reason"]
