"""Decision policy as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Guidance codes in their order of display, and classes by treatment.
GUIDANCE = ["EMPTY_CONTENTS", "WEIGHT_ANOMALY", "REMOVE_STRAW", "REMOVE_CUP_HOLDER", "FOREIGN_MATERIAL", "REMOVE_LABEL", "COMPRESS"]
ALLOWED = ["pet", "plastic", "can", "paper"]
REJECTED = ["glass", "battery", "fluorescent", "styrofoam"]
VINYL = ["vinyl"]


def guidance(cls: Column, anomaly: Column, straw: Column, holder: Column, foreign: Column, label: Column, dented: Column) -> Column:
    """Codes of unmet conditions in order of display; an unknown condition is met."""
    yes, no = (lambda c: c.eqNullSafe(F.lit(True))), (lambda c: c.eqNullSafe(F.lit(False)))
    hollow = cls.isin("pet", "plastic", "can")
    fires = {
        "EMPTY_CONTENTS": yes(anomaly) & hollow,
        "WEIGHT_ANOMALY": yes(anomaly) & cls.isin("paper", "vinyl"),
        "REMOVE_STRAW": yes(straw),
        "REMOVE_CUP_HOLDER": yes(holder) & cls.isin("pet", "plastic"),
        "FOREIGN_MATERIAL": yes(foreign),
        "REMOVE_LABEL": yes(label),
        "COMPRESS": no(dented) & hollow,
    }
    return F.array_compact(F.array(*[F.when(fires[c], F.lit(c)) for c in GUIDANCE]))


def route(cls: Column, confidence: Column, codes: Column, least: float) -> Column:
    """Status of a detection: NOT_DETECTED, GENERAL_WASTE, REJECTED or ALLOWED."""
    return (
        F.when(cls.isNull(), "NOT_DETECTED")
        .when(F.coalesce(confidence < least, F.lit(True)), "GENERAL_WASTE")
        .when(cls.isin(*REJECTED), "REJECTED")
        .when(cls.isin(*ALLOWED, *VINYL), F.when(F.size(codes) > 0, "REJECTED").otherwise("ALLOWED"))
        .otherwise("GENERAL_WASTE")
    )


def correction_reason(baseline: Column, box: Column, internal: Column, external: Column, base_conf: Column, conf: Column, least: Column, margin: Column, veto: bool) -> Column:
    """Why a second opinion does or does not replace the first (nine reasons)."""
    weak, close = F.coalesce(conf < least, F.lit(True)), F.coalesce(conf - base_conf < margin, F.lit(True))
    background = internal.eqNullSafe(F.lit("background"))
    return (
        F.when(baseline.isNull(), "no_baseline_detection")
        .when(box.isNull(), "missing_selected_bbox")
        .when(background, F.when(weak, "background_veto_below_verifier_confidence").when(close, "background_veto_below_verifier_over_yolo_margin").otherwise("background_veto_applied") if veto else F.lit("verifier_background_retain_yolo"))
        .when(external.isNull(), "no_verifier_prediction")
        .when(external == baseline, "external_agreement")
        .when(weak, "below_verifier_confidence")
        .when(close, "below_verifier_over_yolo_margin")
        .otherwise("corrected")
    )


def applied(reason: Column) -> Column:
    return reason.isin("corrected", "background_veto_applied")


def effect(reason: Column, negative: Column, promoted: Column, was_right: Column, is_right: Column) -> Column:
    """What a correction did to a row (six effects)."""
    return (
        F.when(~applied(reason), "unchanged")
        .when((reason == "background_veto_applied") & ~negative, "harmful_positive_suppression")
        .when(promoted, "harmful_negative_promotion")
        .when(~was_right & is_right, "beneficial")
        .when(was_right & ~is_right, "harmful")
        .otherwise("wrong_to_wrong")
    )


# Pairs of classes whose confident disagreement is looked at again.
CONFLICTS = [("can", "plastic"), ("plastic", "paper"), ("plastic", "styrofoam"), ("vinyl", "paper"), ("pet", "glass"), ("glass", "plastic"), ("fluorescent", "glass"), ("fluorescent", "plastic")]


def conflict_recheck(first: Column, confidence: Column, second: Column) -> Column:
    """Whether a confident first opinion and a second one differ in a way that matters for safety; no second one differs from a rejected first."""
    pair = F.concat_ws("/", F.least(first, second), F.greatest(first, second))
    listed = pair.isin(*["/".join(sorted(p)) for p in CONFLICTS])
    strict = (first == "plastic") & second.isin("paper", "styrofoam")
    guarded = F.when(first.isin(*REJECTED), ~F.coalesce(second.isin(*REJECTED), F.lit(False))).otherwise(F.lit(False))
    return F.coalesce(F.when(confidence < 0.85, False).when(strict, confidence >= 0.95).when(listed, True).otherwise(guarded), F.lit(False))


# Thresholds of the decision, by the name of the rule.
TRUST = 0.55
RESCUE = 0.50
DENT = 0.90
VINYL_RULE = {"candidate": 0.10, "ratio": 0.40, "iou": 0.70, "verifier": 0.65, "margin": 0.25}


def vinyl_candidate(cls: Column, confidence: Column, other: Column, other_confidence: Column, iou: Column) -> Column:
    """Whether another box is a vinyl candidate on the same object as a weak pet or plastic one."""
    weak = cls.isin("pet", "plastic") & (confidence < TRUST)
    return F.coalesce(weak & (other == "vinyl") & (other_confidence >= VINYL_RULE["candidate"]) & (other_confidence >= confidence * VINYL_RULE["ratio"]) & (iou >= VINYL_RULE["iou"]), F.lit(False))


def decide(cls: Column, confidence: Column, candidate: Column, second: Column, second_confidence: Column, gate: bool = False) -> tuple[Column, Column, Column, Column]:
    """(class, confidence, correction, deferred): vinyl correction, then rescue of a weak detection, then the agreement gate.

    Without a second opinion nothing is corrected or deferred; for the gate pet and plastic are one.
    """
    vinyl = F.coalesce(candidate & (second == "vinyl") & (second_confidence >= VINYL_RULE["verifier"]) & (second_confidence - confidence >= VINYL_RULE["margin"]), F.lit(False))
    rescue = F.coalesce(~vinyl & (confidence < TRUST) & second.isNotNull() & (second_confidence >= RESCUE), F.lit(False))
    correction = F.when(vinyl, "vinyl").when(rescue, "rescue").otherwise("none")
    final = F.when(vinyl | rescue, second).otherwise(cls)
    one = lambda c: F.when(c == "pet", "plastic").otherwise(c)
    deferred = F.coalesce(one(second) != one(final), F.lit(False)) if gate else F.lit(False)
    return final, F.when(vinyl | rescue, second_confidence).otherwise(confidence), correction, deferred


def head_conditions(has_label: Column, is_dented: Column, label_head: Column, dent_head: Column, dent_confidence: Column) -> tuple[Column, Column]:
    """Conditions as the second opinion's heads say, where both have a say; dented only if the head is sure."""
    label = F.when(has_label.isNotNull() & label_head.isNotNull(), label_head).otherwise(has_label)
    dented = F.when(is_dented.isNotNull() & dent_head.isNotNull(), dent_head & (dent_confidence >= DENT)).otherwise(is_dented)
    return label, dented


def reviewed_label(expected: Column, is_correct: Column, deployed: Column, known: list[str]) -> Column:
    """The class that a review names, or the deployed one if it calls that correct; null for others."""
    named = F.coalesce(F.when(expected != "", expected), F.when(is_correct, deployed))
    return F.when(named.isin(known), named)
