"""Blend of collaborative filtering, means and the model score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starwise.config import Config
from starwise.functions.scalars import clip


def _saturating(n: Column, half: float) -> Column:
    p = F.log1p(n.cast("double"))
    return p / (p + half)


def cf_confidence(n: Column, config: Config) -> Column:
    """Trust in the CF score against the plain means, growing with the neighbour count."""
    return config.cf_conf_base + config.cf_conf_span * _saturating(n, config.cf_conf_half)


def blend_weight(n: Column, config: Config) -> Column:
    """Share of the CF side in the blend with the model."""
    return config.alpha_base + config.alpha_span * _saturating(n, config.alpha_half)


def fallback_score(global_mean: Column, config: Config) -> Column:
    """Score without a model, from item_avg, user_avg and the profiles' own mean ratings."""
    share = config.fallback_mean_share

    def side(mean: str, profile_stars: str) -> Column:
        return share * F.coalesce(mean, global_mean) + (1 - share) * F.coalesce(profile_stars, global_mean)

    return 0.5 * (side("item_avg", "item_stars") + side("user_avg", "user_stars"))


def model_postprocess(raw: Column, fallback: Column, global_mean: Column, config: Config) -> Column:
    """Fallback for NaN, smoothing towards the global mean, clipping."""
    score = F.when(F.isnan(raw), fallback).otherwise(raw)
    smoothed = (1 - config.model_smooth) * score + config.model_smooth * global_mean
    return clip(smoothed, config.min_stars, config.max_stars)


def hybrid_score(model: Column, cf: Column, global_mean: Column, config: Config) -> Column:
    """Model score, blended with CF where the item has enough neighbours."""
    n = F.coalesce("neighbor_cnt", F.lit(0))
    means = 0.5 * (F.coalesce("item_avg", global_mean) + F.coalesce("user_avg", global_mean))
    trust = cf_confidence(n, config)
    alpha = blend_weight(n, config)
    blended = alpha * (trust * cf + (1 - trust) * means) + (1 - alpha) * model
    score = F.when(n >= config.gate_neighbors, blended).otherwise(model)
    smoothed = (1 - config.final_smooth) * score + config.final_smooth * global_mean
    return clip(smoothed, config.min_stars, config.max_stars)
