"""View definitions compiled into lazy DataFrame plans."""
