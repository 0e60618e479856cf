"""Daily behaviour analytics on Spark: land, stage, sessionise, check, publish and report."""

from daybrook.params import Params

__all__ = ["Params"]
