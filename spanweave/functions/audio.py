"""Sound as numpy arrays: WAV files in memory, windows, silence, loudness and log-mel features.

These run inside Python functions on the executors; ``sources.media`` applies them to tables.
"""

from __future__ import annotations

import functools
import io
import wave

import numpy as np

SCALE = 32768.0
#: The published front end's band limits, bands, offset, and frame and hop at 25 frames a second.
LOWEST_HZ, HIGHEST_HZ, BANDS, OFFSET, FRAME_SECONDS, HOP_SECONDS, BASE_FPS = 125.0, 7500.0, 64, 0.01, 0.025, 0.010, 25.0
MEL_BREAK_HZ, MEL_Q = 700.0, 1127.0
FEATURES_EACH = 4


def wav_info(raw: bytes) -> tuple[int, int, int]:
    """Sample rate, frames and channels of a PCM16 WAV file; its samples are not decoded."""
    with wave.open(io.BytesIO(raw)) as f:
        if f.getsampwidth() != 2:
            raise ValueError("the file is not PCM16")
        return f.getframerate(), f.getnframes(), f.getnchannels()


def wav_window(raw: bytes, start: float, seconds: float, sample_rate: int | None = None) -> np.ndarray:
    """A span of a mono PCM16 WAV file as float32 in [-1, 1], cut to the file; another rate than asked fails."""
    rate, n, channels = wav_info(raw)
    if channels != 1:
        raise ValueError("the file is not mono")
    if sample_rate is not None and rate != sample_rate:
        raise ValueError(f"the file has {rate} Hz but {sample_rate} Hz were expected")
    with wave.open(io.BytesIO(raw)) as f:
        f.setpos(min(round(max(0.0, start) * rate), n))
        data = f.readframes(max(0, round(seconds * rate)))
    return np.frombuffer(data, "<i2").astype(np.float32) / SCALE


def wav_bytes(samples: np.ndarray, sample_rate: int) -> bytes:
    """Samples in [-1, 1] as a mono PCM16 WAV file; what is beyond is clipped."""
    if sample_rate <= 0:
        raise ValueError(f"a sample rate must be positive, got {sample_rate}")
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(2)
        f.setframerate(sample_rate)
        f.writeframes(np.round(np.clip(np.asarray(samples, np.float32), -1, 1) * (SCALE - 1)).astype("<i2").tobytes())
    return out.getvalue()


def between(samples: np.ndarray, sample_rate: int, start: float, end: float) -> np.ndarray:
    """The samples between two times, none where there are none."""
    first, last = max(0, round(start * sample_rate)), min(len(samples), round(end * sample_rate))
    return np.asarray(samples[first : max(first, last)], np.float32)


def segment_audio(raw: bytes, origin: float, file_origin: float, seconds: float, sample_rate: int) -> np.ndarray:
    """A segment's sound from the file that begins at ``file_origin``; nothing to read fails."""
    found = wav_window(raw, origin - file_origin, seconds, sample_rate)
    if not len(found):
        raise ValueError(f"reading {origin - file_origin:.3f}s+{seconds:.3f}s yielded no samples")
    return found


def silence(seconds: float, sample_rate: int) -> np.ndarray:
    return np.zeros(max(0, round(seconds * sample_rate)), np.float32)


def joined(parts: list[np.ndarray], gap: float, sample_rate: int) -> np.ndarray:
    """Parts one after the other with a silence between each two."""
    if not parts:
        return np.zeros(0, np.float32)
    pause = silence(gap, sample_rate)
    return np.concatenate([x for i, p in enumerate(parts) for x in ((pause, p) if i else (p,))])


def rms(samples: np.ndarray) -> float:
    """Root mean square, 0 of nothing."""
    return float(np.sqrt(np.mean(np.square(np.asarray(samples, np.float64))))) if len(samples) else 0.0


def _mel(hz) -> np.ndarray:
    return MEL_Q * np.log1p(np.asarray(hz, float) / MEL_BREAK_HZ)


@functools.lru_cache(maxsize=16)
def mel_bank(bins: int, sample_rate: int, bands: int = BANDS, low: float = LOWEST_HZ, high: float = HIGHEST_HZ) -> np.ndarray:
    """Triangles in mel over the bins of a spectrum, one column for each band; the constant bin has no weight."""
    if not 0 <= low < high <= sample_rate / 2:
        raise ValueError(f"bands from {low} to {high} Hz are not inside 0 to {sample_rate / 2}")
    at = _mel(np.linspace(0, sample_rate / 2, bins))[:, None]
    edge = np.linspace(_mel(low), _mel(high), bands + 2)
    left, peak, right = edge[:-2], edge[1:-1], edge[2:]
    bank = np.clip(np.minimum((at - left) / (peak - left), (right - at) / (right - peak)), 0, None)
    bank[0] = 0
    bank.flags.writeable = False
    return bank


def frame_sizes(sample_rate: int = 16_000, fps: float = BASE_FPS) -> tuple[int, int]:
    """Samples of a frame and of a hop; both shrink as the video's rate grows."""
    frame, hop = (round(sample_rate * s * BASE_FPS / fps) for s in (FRAME_SECONDS, HOP_SECONDS))
    if frame <= 0 or hop <= 0:
        raise ValueError(f"{fps} frames a second leave no frame or hop")
    return frame, hop


def mel_of(frames: np.ndarray, sample_rate: int = 16_000) -> np.ndarray:
    """Log-mel features in double precision of whole frames, a row each."""
    frame = frames.shape[1]
    size = 1 << int(np.ceil(np.log2(frame)))
    taper = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(frame) / frame)
    spectrum = np.abs(np.fft.rfft(np.asarray(frames, np.float64) * SCALE * taper, size, axis=1))
    return np.log(spectrum @ mel_bank(size // 2 + 1, sample_rate) + OFFSET)


def mel_rows(samples: np.ndarray, sample_rate: int = 16_000, fps: float = BASE_FPS) -> np.ndarray:
    """Log-mel features in double precision, a row for each hop that a whole frame begins at."""
    frame, hop = frame_sizes(sample_rate, fps)
    if len(samples) < frame:
        return np.zeros((0, BANDS))
    return mel_of(np.lib.stride_tricks.sliding_window_view(np.asarray(samples), frame)[::hop], sample_rate)


def log_mel(samples: np.ndarray, sample_rate: int = 16_000, fps: float = BASE_FPS) -> np.ndarray:
    """``mel_rows`` in single precision."""
    return mel_rows(samples, sample_rate, fps).astype(np.float32)


def window_features(samples: np.ndarray, video_frames: int, fps: float = BASE_FPS) -> np.ndarray:
    """Four rows of features for each video frame; what lacks is taken from the beginning again."""
    if video_frames <= 0:
        raise ValueError(f"a window needs video frames, got {video_frames}")
    found, need = log_mel(samples, fps=fps), video_frames * FEATURES_EACH
    if not len(found):
        return np.zeros((need, BANDS), np.float32)
    if len(found) >= need:
        return found[:need]
    return np.concatenate([found, found[np.arange(need - len(found)) % len(found)]])


def pad_speakers(crops: np.ndarray, width: int) -> np.ndarray:
    """Crops of speakers with black ones added up to ``width``; more speakers than that fail."""
    if len(crops) > width:
        raise ValueError(f"{len(crops)} speakers do not fit an axis of {width}")
    return np.concatenate([crops, np.zeros((width - len(crops), *crops.shape[1:]), crops.dtype)])


def stack_speakers(tiles: list[np.ndarray]) -> np.ndarray:
    """Speakers' tiles, all of as many frames, as one float32 array in the range they have."""
    if not tiles or len({len(t) for t in tiles}) > 1:
        raise ValueError(f"tiles to stack must be some, of as many frames: {[len(t) for t in tiles]}")
    return np.stack(tiles).astype(np.float32)
