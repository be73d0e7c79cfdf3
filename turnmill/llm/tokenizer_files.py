"""Where vocabulary files are: a parameter, with the installed public files as default."""

import os


def tokenizer_path(name: str, folder: str | None = None) -> str:
    """Path of a vocabulary file in `folder`, else in TOKENIZER_DIR, else among the installed ones."""
    folder = folder or os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
