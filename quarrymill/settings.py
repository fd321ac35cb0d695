"""Constants of the curation flow, as defaults of one frozen record."""

from __future__ import annotations

from dataclasses import dataclass

# Picture extensions, and substrings that disqualify a picture URL.
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".webp")
BLOCKED_URL_PARTS = (
    "gstatic", "google", "logo", "icon", "sprite", "emoji", "sticker", "banner", "avatar", "pixel", "1x1", "blank", "spacer", "placeholder",
)
# Escapes in scraped URLs; a quoted picture URL in a page; a thumbnail's size suffix.
URL_ESCAPES = (("\\u003d", "="), ("\\u0026", "&"), ("\\u003c", "<"), ("\\u003e", ">"))
PICTURE_URL = r'(?i)"(https?://[^"]{10,}\.(?:jpg|jpeg|png|webp)(?:[^"]{0,200})?)"'
THUMBNAIL_URL = r"=s[0-9]{1,2}(-c)?$"
# Per-channel statistics of the evaluation transform.
CHANNEL_MEAN = (0.485, 0.456, 0.406)
CHANNEL_STD = (0.229, 0.224, 0.225)


@dataclass(frozen=True)
class Settings:
    accepted_cap: int = 100
    best_per_class: int = 80
    similarity_gate: float = 0.50
    duplicate_cosine: float = 0.92
    duplicate_distance: int = 5
    most_faces: int = 3
    least_bytes: int = 5000
    crop_padding: float = 0.30
    blur_floor: float = 35.0
    dark_floor: float = 25.0
    bright_ceiling: float = 235.0
    least_side: int = 160
    small_penalty: float = 15.0
    image_size: int = 224
    train_percent: int = 75
    val_percent: int = 15
    patience: int = 5
    plateau_patience: int = 2
    plateau_factor: float = 0.5
    plateau_threshold: float = 1e-4
    seed: int = 42


DEFAULTS = Settings()
