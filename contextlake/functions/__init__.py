"""Column functions. All JVM-side except the two JSON walkers in ``json_tools``."""
