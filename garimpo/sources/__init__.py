"""Raw files in, tables out, and the control of what was read."""
