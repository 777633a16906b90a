"""Named queries, their SQL twins and the stage runner."""
