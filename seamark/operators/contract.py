"""The semantic contract: which relations and entity types may become facts, and from what evidence."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

# Thresholds and version of the default contract.
VERSION, CONF_THR, MIN_EVIDENCE = "1.0.0", 0.7, 2

# The relations of the default contract, the labels of their domain and of their range, "*" for any.
RELATIONS = {
    "DEVELOPS": (["Organization", "Person"], ["Technology", "System", "Component", "Tool", "Asset"]),
    "PROVIDES": (["Organization", "Service"], ["Service", "Capability", "Tool", "Technology"]),
    "SPONSORS": (["Organization", "Person"], ["Program", "Project", "Portfolio"]),
    "OPERATES": (["Organization"], ["System", "Service", "Asset"]),
    "LOCATED_IN": (["Organization", "Project", "Person", "Asset", "System", "Component"], ["Location", "kb_Location"]),
    "BASED_IN": (["Organization"], ["Location", "kb_Location"]),
    "MEMBER_OF": (["Person"], ["Organization", "Program", "Project"]),
    "USES_TOOL": (["Person", "Organization", "Project", "System"], ["Tool"]),
    "ADHERES_TO": (["Organization", "Project", "System", "Process"], ["Standard"]),
    "RESPONDED_TO": (["Organization"], ["RFI"]),
    "FUNDS": (["Organization", "Program"], ["Project", "Program"]),
    "DELIVERS": (["Organization", "Project", "Contract"], ["Deliverable"]),
    "USES": (["Project", "System", "Component", "Organization"], ["Technology", "Tool", "Service", "Standard"]),
    "HAS_REQUIREMENT": (["Project", "System", "Component", "Program", "RFI", "Technology"], ["Requirement"]),
    "SEEKS_PARTNER": (["Organization", "Project"], ["Organization"]),
    "ENABLES": (["Capability", "Technology", "System"], ["Capability", "Project"]),
    "LEVERAGES": (["Project", "Organization", "System"], ["Capability", "Technology", "Tool"]),
    "HAS_PROPERTY": (["Technology", "System", "Component", "Asset"], ["Property"]),
    "DESIGNED_FOR": (["System", "Component", "Technology"], ["Environment", "Scenario", "Threat"]),
    "CLASSIFIED_AS": (["Technology", "System", "Threat", "Domain"], ["Domain", "Threat", "Capability"]),
    "APPLIES_TO": (["Standard", "Requirement"], ["Technology", "System", "Project"]),
    "SUPPORTS": (["Capability", "Service", "Technology"], ["Project", "Capability"]),
    "PROTECTS": (["System", "Technology"], ["Asset", "Threat", "Project"]),
    "ACTS_UPON": (["Technology", "System"], ["Threat", "Environment"]),
    "INTEGRATES_WITH": (["System", "Technology", "Component"], ["System", "Technology", "Component"]),
    "PROVIDES_CAPABILITY": (["System", "Technology", "Service", "Organization"], ["Capability"]),
    "SERVICES": (["Organization"], ["Organization", "Project"]),
    "PART_OF": (["Component", "System", "Project"], ["System", "Project", "Portfolio"]),
    "COMPOSED_OF": (["System", "Asset"], ["Component", "Asset"]),
    "ACTS_AGAINST": (["System", "Technology"], ["Threat"]),
    "RELATED_TO": (["*"], ["*"]),
    "FOR_TECHNOLOGY": (["Requirement", "RFI", "Document"], ["Technology"]),
    "ISSUED_BY": (["RFI", "Contract"], ["Organization"]),
    "ABOUT": (["Document"], ["Project", "Technology", "System", "Capability", "Requirement"]),
    "SEEKS": (["RFI"], ["Capability", "Technology", "Service"]),
    "ASKS_ABOUT": (["RFI"], ["Requirement", "Standard", "Capability", "Technology"]),
    "RELATED_TO_TECHNOLOGY": (["*"], ["Technology"]),
    "HAS_MILESTONE": (["Project", "Program", "Contract"], ["Milestone"]),
    "HAS_DELIVERABLE": (["Project", "Contract", "RFI"], ["Deliverable"]),
    "STARTS_AT_TRL": (["Project", "Program", "Technology", "System"], ["TRL"]),
    "ENDS_AT_TRL": (["Project", "Program", "Technology", "System"], ["TRL"]),
    "WORDS_FOR": (["Document"], ["Organization", "Project", "Technology", "System", "RFI", "Contract"]),
    "IS_POC_FOR": (["Person"], ["Project", "Program", "Organization", "RFI"]),
    "VARIANT_OF": (["System", "System_Variant", "kb_System_Variant"], ["System", "kb_System"]),
    "ALIGNED_WITH": (["Project", "Program", "Organization", "Standard"], ["Standard", "Domain", "Program"]),
    "ENDORSED_BY": (["Technology", "System", "Standard"], ["Organization", "Person"]),
}

# Labels and merge keys of the default contract's entity types. Required are the merge keys.
ENTITY_TYPES = {
    "dbo_Organisation": (["Organization"], ["uri"]),
    "dbo_Location": (["kb_Location", "Location"], ["uri", "name"]),
    "dbo_Technology": (["kb_Technology", "Technology"], ["uri"]),
    "kb_Program": (["Program"], ["name"]),
    "kb_Project": (["Project"], ["code"]),
    "kb_Portfolio": (["Portfolio"], ["name"]),
    "kb_Person": (["Person"], ["email"]),
    "kb_Capability": (["Capability"], ["name"]),
    "kb_Asset": (["Asset"], ["name"]),
    "kb_System": (["kb_Asset", "Asset", "System"], ["name"]),
    "kb_System_Variant": (["kb_System", "kb_Asset", "Asset", "System", "System_Variant"], ["name"]),
    "kb_Component": (["Component"], ["name"]),
    "kb_Tool": (["Tool"], ["name"]),
    "kb_Threat": (["Threat"], ["name"]),
    "kb_Property": (["Property"], ["name"]),
    "kb_Environment": (["Environment"], ["name"]),
    "kb_Service": (["Service"], ["name"]),
    "kb_Domain": (["Domain"], ["name"]),
    "kb_Standard": (["Standard"], ["name"]),
    "kb_Requirement": (["Requirement"], ["id"]),
    "kb_TRL": (["TRL"], ["value"]),
    "kb_RFI": (["RFI"], ["rfi_id"]),
    "kb_Contract": (["Contract"], ["name"]),
    "kb_Milestone": (["Milestone"], ["name"]),
    "kb_Scenario": (["Scenario"], ["name"]),
    "kb_Deliverable": (["Deliverable"], ["name"]),
    "kb_Document": (["kb_Deliverable", "Deliverable", "Document"], ["name"]),
    "kb_Prototype": (["kb_Deliverable", "Deliverable", "Prototype"], ["name"]),
}
# Fixed value: the range that the key "value" of this type must lie in.
VALUE_RANGES = {"kb_TRL": [1, 9]}


def default() -> dict:
    """The default contract in the form of a contract file."""
    entities = {k: {"labels": labels, "key": key, "required": key} for k, (labels, key) in ENTITY_TYPES.items()}
    for k, span in VALUE_RANGES.items():
        entities[k]["constraints"] = {"value_range": span}
    relations = {k: {"domain": d, "range": r} for k, (d, r) in RELATIONS.items()}
    return {"schema_version": VERSION, "promotion": {"conf_thr": CONF_THR, "min_evidence": MIN_EVIDENCE}, "entities": entities, "relations": relations}


def load(path: str) -> dict:
    """A contract file: YAML where a parser is installed, else JSON."""
    with open(path, encoding="utf-8") as f:
        body = f.read()
    try:
        import yaml
    except ImportError:
        return json.loads(body)
    return yaml.safe_load(body)


def thresholds(contract: dict, conf_thr: float | None = None, min_ev: int | None = None) -> tuple[float, int]:
    """Least mean confidence and least evidence: as given, else the contract's section ``promotion`` or
    ``promotion_defaults``, else 0.7 and 2."""
    section = contract.get("promotion") or contract.get("promotion_defaults") or {}
    return (float(section.get("conf_thr", CONF_THR)) if conf_thr is None else float(conf_thr)), (int(section.get("min_evidence", MIN_EVIDENCE)) if min_ev is None else int(min_ev))


def rules(spark: SparkSession, contract: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Relation rules ``predicate, domain, range`` and entity rules ``type, labels, key_fields, required, lo, hi``:
    tables of the contract's size. A relation without domain or range takes any labels."""
    c = contract or default()
    r = [(k, list(v.get("domain") or ["*"]), list(v.get("range") or ["*"])) for k, v in (c.get("relations") or {}).items() if v]
    e = []
    for k, v in (c.get("entities") or {}).items():
        v = v or {}
        span = (v.get("constraints") or {}).get("value_range")
        e.append((k, list(v.get("labels") or []), list(v.get("key") or []), list(v.get("required") or []), float(span[0]) if span else None, float(span[1]) if span else None))
    return spark.createDataFrame(r, "predicate string, domain array<string>, range array<string>"), spark.createDataFrame(e, "type string, labels array<string>, key_fields array<string>, required array<string>, lo double, hi double")


def lint(contract: dict) -> list[str]:
    """Labels that relations name and no entity type carries."""
    known = {x for v in contract["entities"].values() for x in v.get("labels") or []} | {"*"}
    return sorted({x for v in contract["relations"].values() for x in [*(v.get("domain") or []), *(v.get("range") or [])]} - known)
