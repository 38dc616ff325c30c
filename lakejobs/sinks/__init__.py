"""Writers for JSON Lines, Bronze, Silver and hot tables."""
