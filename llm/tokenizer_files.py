"""Public tokenizer files, found and told apart where they are used."""

from __future__ import annotations

import hashlib
import os


def tokenizer_path(name: str) -> str:
    """The file of a tokenizer: a path as it is, a bare file name in the public tokenizers' folder.

    Workers call this themselves: the package may be installed elsewhere than on the driver.
    """
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def library_of(name: str) -> str:
    """The library that reads a tokenizer file, by its ending."""
    libraries = {".json": "tokenizers", ".model": "sentencepiece"}
    ending = os.path.splitext(name)[1]
    if ending not in libraries:
        raise ValueError(f"no library for {name}")
    return libraries[ending]


def version_digest(name: str) -> str:
    """SHA-256 of the tokenizer's file, its library and that library's version."""
    library = library_of(name)
    with open(tokenizer_path(name), "rb") as file:
        digest = hashlib.sha256(file.read())
    digest.update(f"\n{library} {__import__(library).__version__}".encode())
    return digest.hexdigest()
