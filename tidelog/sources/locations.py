"""Locations of files and objects, and the Hadoop settings they need."""

from __future__ import annotations

from dataclasses import dataclass, field
from urllib.parse import parse_qsl, quote, unquote, urlsplit


@dataclass(frozen=True)
class Location:
    """``scheme``, ``bucket`` and ``key`` of an object, or a ``path``. The text form never shows the secret."""

    scheme: str
    path: str
    bucket: str = ""
    user: str = field(default="", repr=False)
    secret: str = field(default="", repr=False)
    options: tuple[tuple[str, str], ...] = ()

    @classmethod
    def parse(cls, text: str) -> "Location":
        if "://" not in text:
            windows = len(text) > 1 and text[1] == ":" and text[0].isalpha()
            return cls("file", text.replace("\\", "/") if windows else text)
        u = urlsplit(text)
        scheme = {"s3a": "s3", "s3n": "s3"}.get(u.scheme, u.scheme)
        info, _, host = u.netloc.rpartition("@")
        user, _, secret = info.partition(":")  # on the first colon: a secret may have more
        options = dict(parse_qsl(u.query))
        if scheme == "file":
            return cls("file", unquote(u.path))
        bucket, key = host, unquote(u.path.lstrip("/"))
        if scheme in ("http", "https") and ".s3" in host and host.split(".", 1)[1].startswith("s3"):
            name, rest = host.split(".", 1)
            region = rest.split(".")[1] if rest.count(".") >= 3 else ""
            options |= {"region": region} if region else {}
            scheme, bucket = "s3", name
        return cls(scheme, key, bucket, unquote(user), unquote(secret), tuple(sorted(options.items())))

    @property
    def key(self) -> str:
        return self.path

    @property
    def endpoint(self) -> str:
        return dict(self.options).get("endpoint_override", "")

    @property
    def region(self) -> str:
        return dict(self.options).get("region", "")

    @property
    def parent(self) -> "Location":
        return self._at(self.path.rstrip("/").rpartition("/")[0])

    def _at(self, path: str) -> "Location":
        return Location(self.scheme, path, self.bucket, self.user, self.secret, self.options)

    def join(self, *parts: str) -> "Location":
        return self._at("/".join([self.path.rstrip("/"), *(p.strip("/") for p in parts)]).lstrip("/" if self.bucket else ""))

    def uri(self) -> str:
        """For Spark, without the secret."""
        return self.path if self.scheme == "file" else f"{'s3a' if self.scheme == 's3' else self.scheme}://{self.bucket}/{quote(self.path)}"

    def hadoop(self) -> dict[str, str]:
        if self.scheme != "s3":
            return {}
        out = {f"fs.s3a.bucket.{self.bucket}.access.key": self.user, f"fs.s3a.bucket.{self.bucket}.secret.key": self.secret, f"fs.s3a.bucket.{self.bucket}.endpoint": self.endpoint, f"fs.s3a.bucket.{self.bucket}.endpoint.region": self.region}
        return {k: v for k, v in out.items() if v}
