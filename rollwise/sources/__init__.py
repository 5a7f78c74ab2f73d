"""Source relations: tables by name, transformations, inline rows, unified views."""
