"""Rating prediction as Spark jobs: similar items, a boosted-tree model and their blend."""

from starwise.config import Config, LshConfig, ModelConfig, SkewConfig

__all__ = ["Config", "LshConfig", "ModelConfig", "SkewConfig"]
