"""Code property graphs over Python sources, as Spark jobs."""
