"""Configuration: a frozen dataclass over a JSON document, with defaults, checks and resolved paths."""

from __future__ import annotations

import dataclasses
import json
import math
import os
import warnings
from dataclasses import dataclass, field
from typing import Any


class ConfigError(ValueError):
    """A configuration that cannot be run."""


@dataclass(frozen=True)
class View:
    """One image; rpc is a path, a camera dict, or None for the image's own tags."""

    img: str
    rpc: Any = None
    clr: str | None = None
    cld: str | None = None
    roi: str | None = None
    wat: str | None = None


@dataclass(frozen=True)
class Roi:
    x: int
    y: int
    w: int
    h: int

    @classmethod
    def of(cls, d: dict) -> Roi:
        """Floor of the origin and ceiling of the size."""
        return cls(math.floor(d["x"]), math.floor(d["y"]), math.ceil(d["w"]), math.ceil(d["h"]))


@dataclass(frozen=True)
class Config:
    """All parameters with their defaults; keys that are no Python names are spelled filter_3d_r and filter_3d_n."""

    images: tuple[View, ...]
    roi: Roi | None = None
    roi_geojson: Any = None
    full_img: bool = False
    out_dir: str = "altiplano_output"
    temporary_dir: str = "altiplano_tmp"
    clean_tmp: bool = True
    clean_intermediate: bool = False
    tile_size: int = 800
    horizontal_margin: int = 50
    vertical_margin: int = 10
    border_margin: int = 10
    max_processes: int | None = None
    max_processes_stereo_matching: int | None = None
    omp_num_threads: int = 1
    timeout: int = 600
    debug: bool = False
    dsm_resolution: float = 4
    dsm_radius: float = 0
    dsm_sigma: float | None = None
    relative_sift_match_thresh: bool = True
    sift_match_thresh: float = 0.6
    disp_range_extra_margin: float = 0.2
    max_disp_range: float | None = None
    disp_min: float | None = None
    disp_max: float | None = None
    alt_min: float | None = None
    alt_max: float | None = None
    disp_range_method: str = "wider_sift_exogenous"
    disp_range_exogenous_low_margin: float = -10
    disp_range_exogenous_high_margin: float = 100
    rectification_method: str = "rpc"
    register_with_shear: bool = True
    n_gcp_per_axis: int = 5
    epipolar_thresh: float = 0.5
    max_pointing_error: float = 10
    msk_erosion: float = 2
    fusion_operator: str = "average_if_close"
    fusion_thresh: float = 3
    cargarse_basura: bool = True
    filter_3d_r: float | None = None
    filter_3d_n: int | None = None
    rpc_alt_range_scale_factor: float = 1
    use_srtm: bool = False
    exogenous_dem: str | None = None
    exogenous_dem_geoid_mode: bool = True
    matching_algorithm: str = "mgm"
    census_ncc_win: int = 5
    stereo_speckle_filter: int = 25
    stereo_regularity_multiplier: float = 1.0
    mgm_nb_directions: int = 8
    mgm_timeout: int = 600
    mgm_leftright_threshold: float = 1.0
    mgm_leftright_control: int = 1
    mgm_mindiff_control: int = -1
    out_crs: Any = None
    out_geoid: bool = False
    extra: dict = field(default_factory=dict)

    def to_json(self) -> str:
        """The effective configuration, with out_dir as its own folder."""
        d = dataclasses.asdict(self) | {"out_dir": "."}
        d.update(d.pop("extra"))
        for new, old in (("filter_3d_r", "3d_filtering_r"), ("filter_3d_n", "3d_filtering_n")):
            d[old] = d.pop(new)
        return json.dumps(d, indent=2)


_RENAMED = {"3d_filtering_r": "filter_3d_r", "3d_filtering_n": "filter_3d_n"}


def build(user: dict) -> Config:
    """Checked configuration of a user's dict.  The region is the first of full_img, a whole roi, roi_geojson."""
    images = user.get("images")
    if not isinstance(images, list | tuple) or len(images) < 2 or not all(i.get("img") for i in images):
        raise ConfigError("at least two images with img are needed")
    if user.get("use_srtm") and user.get("exogenous_dem"):
        raise ConfigError("use_srtm and exogenous_dem exclude each other")
    known = {f.name for f in dataclasses.fields(Config)} - {"extra", "images", "roi"}
    out: dict[str, Any] = {"extra": {}}
    for k, v in user.items():
        name = _RENAMED.get(k, k)
        if name in known:
            out[name] = v
        elif k not in ("images", "roi"):
            warnings.warn(f"unknown parameter {k}", stacklevel=2)
            out["extra"][k] = v
    roi = user.get("roi")
    if user.get("full_img"):
        out["full_img"] = True
    elif isinstance(roi, dict) and all(k in roi for k in "xywh"):
        out["roi"] = Roi.of(roi)
    elif not user.get("roi_geojson"):
        raise ConfigError("a region is needed: full_img, roi with x y w h, or roi_geojson")
    views = {f.name for f in dataclasses.fields(View)}
    return Config(images=tuple(View(**{k: v for k, v in i.items() if k in views}) for i in images), **out)


def read(path: str) -> Config:
    """The configuration of a JSON file; relative paths are relative to its folder."""
    with open(path) as f:
        user = json.load(f)
    base = os.path.dirname(os.path.abspath(path))
    whole = lambda p: os.path.join(base, p) if isinstance(p, str) and not os.path.isabs(p) else p
    for k in ("out_dir", "roi_geojson", "exogenous_dem"):
        if k in user:
            user[k] = whole(user[k])
    for i in user.get("images", []):
        for k in ("img", "rpc", "clr", "cld", "roi", "wat"):
            if i.get(k):
                i[k] = whole(i[k])
    return build(user)
