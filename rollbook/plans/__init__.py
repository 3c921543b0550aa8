"""Register plans: site variants and assembly."""
