from presswork.plans.enrich import enrich

__all__ = ["enrich"]
