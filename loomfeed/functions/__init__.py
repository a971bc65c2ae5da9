from . import codes, dates, fingerprint, text

__all__ = ["codes", "dates", "fingerprint", "text"]
