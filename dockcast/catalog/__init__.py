"""Part of dockcast."""
