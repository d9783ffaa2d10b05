"""Evidence-checked organisation / person records as Spark DataFrame jobs."""

from tieproof.config import Config

__all__ = ["Config"]
