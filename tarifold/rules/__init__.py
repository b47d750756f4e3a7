"""Rule data: fixed values that results depend on. Every operator takes them as
arguments, so adding a brand, a make or a tag rule is a data edit."""
