"""DuckDB oracle: the report's stages as SQL over the stand-in inputs."""
