from curate.registry import changes, cleaning, landing, quality, questions

_PARTS = (
    cleaning.REGISTRY,
    quality.REGISTRY,
    questions.REGISTRY,
    landing.REGISTRY,
    changes.REGISTRY,
)


def entries():
    return {name: entry for part in _PARTS for name, entry in part.items()}
