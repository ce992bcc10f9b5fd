"""Named views for SQL users."""


def register_views(frames, prefix=""):
    """Register each frame as a temporary view; returns the view names."""
    names = []
    for name, frame in frames.items():
        frame.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
