"""End-to-end plans: build every model, write the published tables."""

from idloom.plans.pipeline import Pipeline, target_schema

__all__ = ["Pipeline", "target_schema"]
